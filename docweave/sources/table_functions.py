"""Functions that give tables, for SQL: their schema follows their arguments, and they take whole tables, dealt out by key.

``last_of(TABLE(t) PARTITION BY k ORDER BY (at))``   each partition's last row as it is, and ``n_rows``
``changes_of(TABLE(t) PARTITION BY k ORDER BY (at), 'column')``   the rows whose column differs from the row before, with that one's value as ``before``
``json_fields(payload, 'name type, ...')``   the named fields of a JSON object as columns of the given types; what is missing or of another type is null

Rows of a partition go through one after another, in order, with one row held; a partition is one task's work, so a key with very many rows is better served by a
window. A table without rows gives none..
"""

from __future__ import annotations

import json

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..session import runs_on_executors

runs_on_executors(__name__)


def _table(argument: AnalyzeArgument) -> T.StructType:
    if not argument.isTable:
        raise ValueError("the first argument is a table: TABLE(...) PARTITION BY ...")
    return argument.dataType


@udtf
class LastOf:
    def __init__(self) -> None:
        self.last, self.n = None, 0

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(T.StructType([*_table(rows).fields, T.StructField("n_rows", T.LongType())]))

    def eval(self, rows: Row):
        self.last, self.n = rows, self.n + 1

    def terminate(self):
        if self.last is not None:
            yield (*self.last, self.n)


@udtf
class ChangesOf:
    def __init__(self) -> None:
        self.begun, self.before = False, None

    @staticmethod
    def analyze(rows: AnalyzeArgument, column: AnalyzeArgument) -> AnalyzeResult:
        fields = _table(rows)
        if column.value not in fields.names:
            raise ValueError(f"the table has no column {column.value}")
        return AnalyzeResult(T.StructType([*fields.fields, T.StructField("before", fields[column.value].dataType)]))

    def eval(self, rows: Row, column: str):
        now = rows[column]
        if self.begun and now != self.before:
            yield (*rows, self.before)
        self.begun, self.before = True, now


#: Types that fields can have, and what JSON values they take.
_TYPES = {"string": T.StringType(), "long": T.LongType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
_KINDS = {T.StringType: str, T.LongType: int, T.IntegerType: int, T.DoubleType: (int, float), T.BooleanType: bool}


def _fields(text: str) -> T.StructType:
    """``name type, ...``; parsed here, as functions are analysed where there is no session."""
    pairs = [p.split() for p in text.split(",")]
    if bad := [" ".join(p) for p in pairs if len(p) != 2 or p[1].lower() not in _TYPES]:
        raise ValueError(f"fields that can't be had: {bad}")
    return T.StructType([T.StructField(name, _TYPES[kind.lower()]) for name, kind in pairs])


@udtf
class JsonFields:
    @staticmethod
    def analyze(payload: AnalyzeArgument, fields: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(fields.value, str):
            raise ValueError("the fields are a literal: 'name type, ...'")
        return AnalyzeResult(_fields(fields.value))

    def eval(self, payload: str, fields: str):
        schema = _fields(fields)
        try:
            found = json.loads(payload) if payload is not None else {}
        except ValueError:
            found = {}

        def of(f: T.StructField):
            v = found.get(f.name) if isinstance(found, dict) else None
            kinds = _KINDS[type(f.dataType)]
            if not isinstance(v, kinds) or isinstance(v, bool) and kinds is not bool:
                return None
            return float(v) if isinstance(f.dataType, T.DoubleType) else v

        yield tuple(of(f) for f in schema)


def register(spark: SparkSession) -> None:
    """Under their names, for SQL."""
    for name, f in (("last_of", LastOf), ("changes_of", ChangesOf), ("json_fields", JsonFields)):
        spark.udtf.register(name, f)
