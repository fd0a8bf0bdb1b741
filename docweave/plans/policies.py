"""Row policies and column masks as data: a table of policies compiled into a view, the role a session variable.

A policy lets a role do a command on a table's rows that fit a predicate; a role without one sees none of them. The policies of a role are alternatives, as rows
of one table; masks put an expression in a column's place for a role. The view's predicate names every role beside its own; the variable is folded to its
value when a query is planned, so that what is left of it reaches the scan, and what the role may not see is never read. A frame keeps the role that it was planned with.

Predicates and masks are SQL over the table's columns, written by who owns the table; roles are compared as text and are never part of it. A null predicate is no row's;
a predicate that is null for a row leaves it out.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: The variable that holds a session's role, and what it is before one is set.
ROLE, NOBODY = "docweave_role", "nobody"
COMMANDS = ("select", "insert", "update", "delete")
#: Policies at most: they become one expression.
MOST_POLICIES = 1000
SCHEMA = "table_name string, role string, command string, predicate string, masks map<string,string>"


@dataclass(frozen=True)
class Policy:
    table: str
    role: str
    command: str = "select"  # or ``all``
    predicate: str | None = "true"
    masks: dict[str, str] = field(default_factory=dict)


def standard(table: str, public: str = "true") -> list[Policy]:
    """Three roles (fixed values): the service does all, who has signed in reads all, anyone reads what is public."""
    return [Policy(table, "service_role", "all"), Policy(table, "authenticated"), Policy(table, "anon", predicate=public)]


def read(policies: DataFrame) -> list[Policy]:
    """From a table of ``SCHEMA``, a lookup of at most ``MOST_POLICIES`` rows."""
    rows = policies.limit(MOST_POLICIES + 1).collect()
    if len(rows) > MOST_POLICIES:
        raise ValueError("more policies than a lookup has")
    return [Policy(r["table_name"], r["role"], r["command"], r["predicate"], dict(r["masks"] or {})) for r in rows]


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _of(policies: Iterable[Policy], table: str, command: str) -> list[Policy]:
    return [p for p in policies if p.table == table and p.command in (command, "all") and p.predicate is not None and p.role is not None]


def allowed(policies: Iterable[Policy], table: str, role: str, command: str) -> bool:
    """Whether a role has any policy for a command."""
    if command not in COMMANDS:
        raise ValueError(f"no command {command}")
    return any(p.role == role for p in _of(policies, table, command))


def predicate(policies: Iterable[Policy], table: str, command: str = "select") -> str:
    """Which rows the session's role may see, or change, as SQL."""
    return " OR ".join(f"({ROLE} = {_text(p.role)} AND ({p.predicate}))" for p in _of(policies, table, command)) or "false"


def _column(policies: Sequence[Policy], name: str) -> str:
    quoted = f"`{name.replace('`', '``')}`"
    cases = [(p.role, p.masks[name]) for p in policies if name in p.masks]
    return f"CASE {' '.join(f'WHEN {ROLE} = {_text(r)} THEN {m}' for r, m in cases)} ELSE {quoted} END AS {quoted}" if cases else quoted


def use_role(spark: SparkSession, role: str) -> None:
    """What is planned from now on in this session is for this role."""
    declare(spark)
    spark.sql(f"SET VAR {ROLE} = :role", args={"role": role})


def declare(spark: SparkSession) -> None:
    """The variable, unless the session has it."""
    try:
        spark.sql(f"SELECT {ROLE}")
    except AnalysisException:
        spark.sql(f"DECLARE VARIABLE {ROLE} STRING DEFAULT {_text(NOBODY)}")


def secured(df: DataFrame, name: str, policies: Sequence[Policy], table: str | None = None) -> None:
    """A temporary view ``name`` of ``df`` that shows each role its rows, masked. Masks of several policies of a role: the first counts."""
    spark = df.sparkSession
    declare(spark)
    mine = _of(policies, table or name, "select")
    unknown = {m for p in mine for m in p.masks} - set(df.columns)
    if unknown:
        raise ValueError(f"masks of columns that aren't there: {sorted(unknown)}")
    df.createOrReplaceTempView(f"{name}_unsecured")
    columns = ", ".join(_column(mine, c) for c in df.columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` AS SELECT {columns} FROM `{name}_unsecured` WHERE {predicate(policies, table or name)}")
