"""Registered queries and their SQL, and what both are written with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: An exact sum of amounts in cents.
MONEY = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


def query(sql: str):
    def add(f: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        names = f.__code__.co_varnames[: f.__code__.co_argcount]

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names])

        QUERIES[f.__name__], ORACLES[f.__name__] = run, sql
        return f

    return add


def long(c: Column) -> Column:
    return c.cast("long")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_case(value: str, table: dict) -> str:
    """The table's entry for the value, null without one."""
    return f"CASE {value} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items()) + " END"


def nth(items: list[str | None], number: Column) -> Column:
    """The item at the number, counted round."""
    return F.try_element_at(F.array(*[F.lit(x) for x in items]), (number % len(items) + 1).cast("int"))


def sql_nth(items: list[str | None], number: str) -> str:
    return f"[{', '.join('NULL' if x is None else quoted(x) for x in items)}][({number}) % {len(items)} + 1]"
