"""An immutable query builder over DataFrames: what it builds is an unresolved plan that Catalyst checks and optimises."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TESTS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
    "in": lambda c, v: c.isin(*v) if len(v) else F.lit(False),
    "between": lambda c, v: c.between(*v),
    "is null": lambda c, v: c.isNull(),
    "is not null": lambda c, v: c.isNotNull(),
}


def condition(column: str, operator: str, value: Any = None) -> Column:
    """``column operator value``; an unknown operator raises. ``= None`` is never true, as in SQL; an empty ``in`` holds no row."""
    test = _TESTS.get(operator.lower())
    if test is None:
        raise ValueError(f"unknown operator: {operator}")
    return test(F.col(column), F.lit(None) if value is None and operator.lower() not in ("is null", "is not null") else value)


def ordered(columns: Iterable[str | tuple[str, str]]) -> list[Column]:
    """Ascending puts nulls last, descending first."""
    out = []
    for c in columns:
        name, way = (c, "asc") if isinstance(c, str) else c
        out.append(F.col(name).desc_nulls_first() if way.lower() == "desc" else F.col(name).asc_nulls_last())
    return out


@dataclass(frozen=True)
class Query:
    """Each method gives a new query; ``frame()`` the DataFrame. Filters are joined by AND; they and the projection reach the scan."""

    source: DataFrame
    columns: tuple[str | Column, ...] = ()
    filters: tuple[Column, ...] = ()
    joins: tuple[tuple[DataFrame, str, str], ...] = ()
    order: tuple[str | tuple[str, str], ...] = ()
    most: int | None = None
    skip: int | None = None

    def select(self, *columns: str | Column) -> Query:
        return replace(self, columns=columns)

    def where(self, column: str, operator: str, value: Any = None) -> Query:
        return replace(self, filters=(*self.filters, condition(column, operator, value)))

    def where_in(self, column: str, values: Any) -> Query:
        """A list asks for membership, a single value for equality."""
        return self.where(column, "in", list(values)) if isinstance(values, (list, tuple, set)) else self.where(column, "=", values)

    def where_between(self, column: str, low: Any, high: Any) -> Query:
        return self.where(column, "between", (low, high))

    def where_null(self, column: str) -> Query:
        return self.where(column, "is null")

    def where_not_null(self, column: str) -> Query:
        return self.where(column, "is not null")

    def matching(self, test: Column) -> Query:
        return replace(self, filters=(*self.filters, test))

    def join(self, other: DataFrame, on: str, how: str = "inner") -> Query:
        """``on``: any SQL condition over both sides' columns; Catalyst picks the join's kind."""
        return replace(self, joins=(*self.joins, (other, on, how)))

    def order_by(self, *columns: str | tuple[str, str]) -> Query:
        return replace(self, order=(*self.order, *columns))

    def limit(self, n: int) -> Query:
        return replace(self, most=n)

    def offset(self, n: int) -> Query:
        return replace(self, skip=n)

    def _rows(self) -> DataFrame:
        df = self.source
        for other, on, how in self.joins:
            df = df.join(other, F.expr(on), how)
        for f in self.filters:
            df = df.where(f)
        return df

    def frame(self) -> DataFrame:
        df = self._rows()
        if self.order:
            df = df.orderBy(*ordered(self.order))
        if self.skip:
            df = df.offset(self.skip)
        if self.most is not None:
            df = df.limit(self.most)
        return df.select(*self.columns) if self.columns else df

    def first(self):
        return self.limit(1).frame().first()

    def count(self) -> int:
        """Of all that fits; order, limit and offset don't count."""
        return self._rows().count()

    def counted(self, name: str = "n") -> DataFrame:
        return self._rows().agg(F.count(F.lit(1)).alias(name))

    def page(self, number: int, size: int) -> DataFrame:
        """Rows of page ``number`` (from 1) in the query's order."""
        if not self.order:
            raise ValueError("a page needs an order")
        return self.offset((number - 1) * size).limit(size).frame()

    def page_info(self, number: int, size: int) -> DataFrame:
        """page, page_size, total, pages, has_next, has_prev."""
        n = F.count(F.lit(1))
        pages = F.ceil(n / size).cast("long")
        return self._rows().agg(F.lit(number).alias("page"), F.lit(size).alias("page_size"), n.alias("total"), pages.alias("pages"), (F.lit(number) < pages).alias("has_next"), F.lit(number > 1).alias("has_prev"))


def table(spark: SparkSession, path: str) -> Query:
    return Query(spark.read.parquet(path))


def sql(spark: SparkSession, text: str, **args: Any) -> DataFrame:
    """SQL with named parameters, ``:name``."""
    return spark.sql(text, args=args)
