"""Workflows broken off at each stage resume to the same tables."""

import pytest
from pyspark.sql import functions as F

from docweave.plans.workflow import GivenUp, Stage, Workflow


@pytest.fixture
def setup(spark, tmp_path):
    spark.range(20).write.parquet(f"{tmp_path}/in")
    ran, broken = [], set()

    def step(name, f):
        def run(*tables, **parameters):
            ran.append(name)
            if name in broken:
                raise RuntimeError(f"{name} is broken")
            return f(*tables, **parameters)

        return run

    def stages(least=5, attempts=1):
        return [
            Stage("kept", step("kept", lambda t, least: t.where(F.col("id") >= least)), ("in",), {"least": least}, attempts=attempts),
            Stage("twice", step("twice", lambda t: t.select((F.col("id") * 2).alias("id"))), ("kept",), attempts=attempts),
            Stage("both", step("both", lambda a, b: a.unionByName(b)), ("kept", "twice"), attempts=attempts),
        ]

    flow = lambda: Workflow(spark, f"file://{tmp_path}/flow")  # noqa: E731  a new process knows the folder alone
    return {"in": f"file://{tmp_path}/in"}, stages, ran, broken, flow


def ids(df):
    return sorted(r["id"] for r in df.collect())


WANT = sorted([*range(5, 20), *range(10, 40, 2)])


@pytest.mark.parametrize("at", ["kept", "twice", "both"])
def test_broken_off_and_resumed(setup, at):
    sources, stages, ran, broken, flow = setup
    broken.add(at)
    with pytest.raises(RuntimeError, match=f"{at} is broken"):
        flow().run(sources, stages(attempts=1))
    before = list(ran)
    broken.clear()
    with pytest.raises(GivenUp):  # its one try is used up
        flow().run(sources, stages(attempts=1))
    out = flow().run(sources, stages(attempts=2))
    assert ids(out["both"]) == WANT
    assert ran == [*before, *["kept", "twice", "both"][["kept", "twice", "both"].index(at) :]]
    flow().run(sources, stages())
    assert len(ran) == len(before) + 3 - ["kept", "twice", "both"].index(at)  # nothing runs again


def test_changes_run_what_depends_on_them(spark, setup):
    sources, stages, ran, _, flow = setup
    flow().run(sources, stages())
    out = flow().run(sources, stages(least=18))
    assert ids(out["both"]) == [18, 19, 36, 38] and ran == ["kept", "twice", "both"] * 2
    assert ids(flow().run(sources, stages())["both"]) == WANT and len(ran) == 6  # the old output is there still
    spark.range(20, 21).write.mode("append").parquet(sources["in"])
    assert ids(flow().run(sources, stages())["both"]) == sorted([*WANT, 20, 40]) and len(ran) == 9


def test_tries_are_counted(setup):
    sources, stages, ran, broken, flow = setup
    broken.add("twice")
    with pytest.raises(RuntimeError, match="is broken"):
        flow().run(sources, stages(attempts=3))
    mark = flow().fingerprints(sources, stages())["twice"]
    assert ran.count("twice") == 3 and flow().tries("twice", mark) == 3
    assert flow().ledger.names("out/twice") == []  # nothing is left of broken tries
    broken.clear()
    flow().forgive("twice", mark)
    assert ids(flow().run(sources, stages(attempts=3))["both"]) == WANT


def test_orders_that_cannot_be(setup):
    sources, stages, ran, _, flow = setup
    with pytest.raises(ValueError, match="wants"):
        flow().run(sources, stages()[1:])
    with pytest.raises(ValueError, match="already"):
        flow().run(sources, [*stages(), stages()[0]])
    assert ran == []
