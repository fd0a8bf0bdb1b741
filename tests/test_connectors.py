"""Remote calls at a slow and failing stand-in."""

import asyncio
import threading
import time

from pyspark.sql import functions as F

from docweave.sources import connectors as C


class Service:
    """Counts what is open at once."""

    def __init__(self, seconds=0.05):
        self.seconds, self.open, self.most, self.calls, self.lock = seconds, 0, 0, [], threading.Lock()

    def enter(self, prompt):
        with self.lock:
            self.open += 1
            self.most = max(self.most, self.open)
            self.calls.append(prompt)

    async def __call__(self, prompt):
        self.enter(prompt)
        await asyncio.sleep(self.seconds)
        self.open -= 1
        if prompt.startswith("bad") or prompt.startswith("once") and self.calls.count(prompt) == 1:
            raise ConnectionError(f"{prompt} refused")
        return prompt.upper()

    def plainly(self, prompt):
        self.enter(prompt)
        time.sleep(self.seconds)
        with self.lock:
            self.open -= 1
        return prompt.upper()


def run(call, prompts, **limits):
    limits = C.Limits(**{"first_wait": 0.01, **limits})
    return asyncio.run(C._asked(call, prompts, limits, C.Breaker(limits, time.monotonic)))


def test_bound_order_and_speed():
    """40 calls of 50 ms, 8 at once, take a fifth of a second or so and not two; answers keep their order, coroutine or thread."""
    for plain in (False, True):
        s = Service()

        async def call(p, s=s):
            return await s(p)

        prompts = [f"p{i}" for i in range(40)]
        began = time.monotonic()
        got = run(s.plainly if plain else call, prompts, open_calls=8)
        assert [a for a, _, _ in got] == [p.upper() for p in prompts]
        assert s.most == 8 and time.monotonic() - began < 1.2


def test_failures_are_findings():
    s = Service(0.001)

    async def call(p):
        return await s(p)

    got = run(call, ["a", "bad", None, "once"], attempts=2)
    assert got == [("A", None, 1), (None, "ConnectionError: bad refused", 2), (None, None, 0), ("ONCE", None, 2)]


def test_backoff_and_deadline():
    waits, real = [], asyncio.sleep

    async def bad(p):
        raise OSError("down")

    async def noted(s):
        waits.append(s)
        await real(0)

    asyncio.sleep = noted
    try:
        assert run(bad, ["x"], attempts=6, first_wait=1, most_wait=5) == [(None, "OSError: down", 6)]
        assert waits == [1, 2, 4, 5, 5]
        assert run(bad, ["x"], attempts=6, first_wait=1, deadline=0.5) == [(None, "no answer within 0.5 s: OSError: down", 1)]
    finally:
        asyncio.sleep = real

    async def slow(p):
        await asyncio.sleep(5)

    assert run(slow, ["x"], deadline=0.05) == [(None, "no answer within 0.05 s", 1)]


def test_breaker():
    """After three failures in a row nothing is asked, until the time has passed; one call then decides."""
    now = [0.0]
    b = C.Breaker(C.Limits(breaker=3, closed_for=10), lambda: now[0])
    for _ in range(3):
        assert b.lets()
        b.note(True)
    assert not b.lets()
    now[0] = 11
    assert b.lets() and not b.lets()  # one at a time
    b.note(True)
    assert not b.lets()
    now[0] = 22
    assert b.lets()
    b.note(False)
    assert b.lets() and b.lets()
    s = Service(0)

    async def call(p):
        return await s(p)

    got = run(call, [f"bad{i}" for i in range(30)], open_calls=1, attempts=1, breaker=5)
    assert len(s.calls) == 5 and got[5][1].startswith("not asked")


def test_columns(spark):
    """In Spark: rows keep their answers, a failing one is a finding, an empty table is empty."""

    async def call(p):
        await asyncio.sleep(0.001)
        if p == "7":
            raise ValueError("seven")
        return p * 2

    df = spark.range(20).repartition(3).select("id", F.when(F.col("id") != 3, F.col("id").cast("string")).alias("p"))
    ask = C.asked(call, C.Limits(attempts=2, first_wait=0.001))
    got = {r["id"]: (r["answer"], r["problem"], r["tries"]) for r in df.withColumn("a", ask(F.col("p"))).select("id", "a.*").collect()}
    assert got == {i: (None, None, 0) if i == 3 else (None, "ValueError: seven", 2) if i == 7 else (str(i) * 2, None, 1) for i in range(20)}
    assert df.limit(0).withColumn("a", ask(F.col("p"))).collect() == []
