"""Table functions in SQL: schemas that follow arguments, partitions in order, refusals."""

import pytest

from docweave.sources import table_functions


@pytest.fixture(scope="module")
def sql(spark):
    table_functions.register(spark)
    spark.createDataFrame([("a", 2, "x"), ("a", 1, "x"), ("a", 3, None), ("b", 1, "y"), (None, 1, "z"), ("a", 4, "x")], "k string, at int, v string").createOrReplaceTempView("tf")
    return lambda q: sorted(map(tuple, spark.sql(q).collect()), key=str)


def test_last_of(spark, sql):
    assert sql("SELECT * FROM last_of(TABLE(tf) PARTITION BY k ORDER BY at)") == sorted([("a", 4, "x", 4), ("b", 1, "y", 1), (None, 1, "z", 1)], key=str)
    assert spark.sql("SELECT * FROM last_of(TABLE(SELECT at, k FROM tf) PARTITION BY k)").dtypes == [("at", "int"), ("k", "string"), ("n_rows", "bigint")]
    assert sql("SELECT * FROM last_of(TABLE(SELECT * FROM tf WHERE at > 9) PARTITION BY k)") == []


def test_changes_of(sql):
    assert sql("SELECT * FROM changes_of(TABLE(tf) PARTITION BY k ORDER BY (at), 'v')") == sorted([("a", 3, None, "x"), ("a", 4, "x", None)], key=str)
    with pytest.raises(Exception, match="no column"):
        sql("SELECT * FROM changes_of(TABLE(tf) PARTITION BY k ORDER BY (at), 'w')")


def test_json_fields(spark, sql):
    got = spark.sql("""SELECT * FROM json_fields('{"a": 1, "b": 2, "c": true, "d": "x"}', 'a long, b double, c boolean, d string, e string, A int')""")
    assert got.dtypes[:5] == [("a", "bigint"), ("b", "double"), ("c", "boolean"), ("d", "string"), ("e", "string")]
    assert sql("""SELECT * FROM json_fields('{"a": 1, "b": 2, "c": true, "d": "x"}', 'a long, b double, c boolean, d string, e string')""") == [(1, 2.0, True, "x", None)]
    assert sql("SELECT * FROM json_fields('broken', 'a long')") == sql("SELECT * FROM json_fields(NULL, 'a long')") == sql("""SELECT * FROM json_fields('{"a": true}', 'a long')""") == [(None,)]
    with pytest.raises(Exception, match="can't be had"):
        sql("SELECT * FROM json_fields('{}', 'a array<int>')")
