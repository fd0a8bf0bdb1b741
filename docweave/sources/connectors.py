"""Remote services as interfaces, with deterministic offline stand-ins; what they compute is pure and runs as columns."""

from __future__ import annotations

import asyncio
import inspect
import time
from collections.abc import Awaitable, Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import runs_on_executors

runs_on_executors(__name__)

#: A call to a service, as a coroutine or not.
Call = Callable[[str], str | None] | Callable[[str], Awaitable[str | None]]

# Dollars per token by model, and models by how complex a section is.
PRICES = {"large": 0.000125, "small": 0.00003}
COMPLEX_ITEMS = (19, 20, 21)


def model_for(item: Column, tokens: Column, limit: int = 8000) -> Column:
    """The model that a section asks for: the large one for complex items and long texts."""
    return F.when(item.isin(*COMPLEX_ITEMS) | (tokens > limit), "large").otherwise("small")


def cost(model: Column, tokens: Column) -> Column:
    prices = F.create_map(*[F.lit(x) for kv in PRICES.items() for x in kv])
    return F.try_element_at(prices, model) * tokens


@dataclass(frozen=True)
class Limits:
    """How a task asks: calls open at once, tries of a call, seconds of the first wait between tries (doubled each time, to ``most_wait``), seconds for a call with all its tries, and failed calls in a row that open the breaker, with the seconds until it lets one call through."""

    open_calls: int = 16
    attempts: int = 3
    first_wait: float = 0.5
    most_wait: float = 60.0
    deadline: float = 300.0
    breaker: int = 20
    closed_for: float = 30.0


class Breaker:
    """After too many failed calls in a row none is made for a while; then one is let through, and its end decides."""

    def __init__(self, limits: Limits, clock: Callable[[], float]):
        self.limits, self.clock, self.failures, self.until, self.trying = limits, clock, 0, 0.0, False

    def lets(self) -> bool:
        if self.failures < self.limits.breaker:
            return True
        if self.trying or self.clock() < self.until:
            return False
        self.trying = True
        return True

    def note(self, failed: bool) -> None:
        self.trying = False
        self.failures = self.failures + 1 if failed else 0
        if self.failures >= self.limits.breaker:
            self.until = self.clock() + self.limits.closed_for


async def _asked(call: Call, prompts: list[str | None], limits: Limits, breaker: Breaker) -> list[tuple[str | None, str | None, int]]:
    """Answer, problem and tries of each prompt, in their order; as many at once as the limits say."""
    gate = asyncio.Semaphore(limits.open_calls)
    loop = asyncio.get_running_loop()

    async def once(prompt: str, left: float) -> str | None:
        if inspect.iscoroutinefunction(call):
            return await asyncio.wait_for(call(prompt), left)
        return await asyncio.wait_for(loop.run_in_executor(pool, call, prompt), left)

    async def one(prompt: str | None) -> tuple[str | None, str | None, int]:
        if prompt is None:
            return None, None, 0
        async with gate:
            end, problem, wait = loop.time() + limits.deadline, "no try", limits.first_wait
            for n in range(1, limits.attempts + 1):
                if not breaker.lets():
                    return None, "not asked: too many calls failed", n - 1
                try:
                    answer = await once(prompt, max(end - loop.time(), 0))
                    breaker.note(False)
                    return answer, None, n
                except TimeoutError:
                    breaker.note(True)
                    return None, f"no answer within {limits.deadline:g} s", n
                except Exception as e:  # noqa: BLE001  whatever a service raises
                    breaker.note(True)
                    problem = f"{type(e).__name__}: {e}"[:500]
                if n < limits.attempts:
                    if loop.time() + wait >= end:
                        return None, f"no answer within {limits.deadline:g} s: {problem}"[:500], n
                    await asyncio.sleep(wait)
                    wait = min(2 * wait, limits.most_wait)
            return None, problem, limits.attempts

    pool = ThreadPoolExecutor(limits.open_calls)
    try:
        return await asyncio.gather(*map(one, prompts))
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def asked(call: Call, limits: Limits = Limits()) -> Callable[[Column], Column]:
    """A text function at a remote service, as a column of answer, problem and tries. Each task has an event loop and a breaker of its own, so the calls open in all are ``open_calls`` times the tasks at work.

    ``call`` is a coroutine function, or a plain one that then runs in threads. A row that fails is a finding in ``problem`` and fails no other; a null prompt isn't asked. Rows keep their order.
    A batch is asked as a whole before the next one is read, so that what waits is bounded by Arrow's batch size.
    """

    @F.arrow_udf("struct<answer string, problem string, tries int>")
    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        breaker = Breaker(limits, time.monotonic)
        for prompts in batches:
            rows = asyncio.run(_asked(call, prompts.to_pylist(), limits, breaker))
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32()))], ["answer", "problem", "tries"])

    return ask


def remote(call: Call, attempts: int = 3, limits: Limits | None = None) -> Callable[[Column], Column]:
    """The answer of ``asked`` alone; one that never comes is null."""
    ask = asked(call, limits or Limits(attempts=attempts, first_wait=0.01))
    return lambda prompt: ask(prompt)["answer"]


def first_answer(df: DataFrame, prompt: str, providers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``df`` with the answer of the first provider that gives one, and that provider's name. A provider is asked only for what those before it left open."""
    out = df.withColumns({"__ask": F.col(prompt), "answer": F.lit(None).cast("string"), "provider": F.lit(None).cast("string")})
    for name, f in providers.items():
        out = out.withColumn("__got", f(F.col("__ask"))).withColumns({"answer": F.coalesce("answer", "__got"), "provider": F.coalesce("provider", F.when(F.col("__got").isNotNull(), name))})
        out = out.withColumn("__ask", F.when(F.col("answer").isNull(), F.col(prompt)))
    return out.drop("__ask", "__got")


def upload_problems(name: Column, size: Column, source: Column, issued: Column) -> Column:
    """What is wrong with an upload: none of the sources, no PDF, over 50 MB, no date."""
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(source.isin("MN", "WI"), F.lit(False)), "unknown source"),
            F.when(~F.coalesce(F.lower(name).endswith(".pdf"), F.lit(False)), "not a PDF"),
            F.when(F.coalesce(size, F.lit(0)) > 50 * 2**20, "over 50 MB"),
            F.when(issued.try_cast("date").isNull(), "no date"),
        )
    )
