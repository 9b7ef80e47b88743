"""Relational pieces that several plans share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by an explicit order; dropDuplicates would take any."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds what is missing as nulls of the given types."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def pick(df: DataFrame, *names: str) -> Column:
    """The first of the columns that is there, as text: chosen by the schema, not by the value; null if none is."""
    return next((F.col(n).cast("string") for n in names if n in df.columns), F.lit(None).cast("string"))


def total(c: Column | str) -> Column:
    """An exact sum of amounts in cents, as a double: it does not hang on the order of rows."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")).cast("double")


def medians(df: DataFrame, columns: Sequence[str], accuracy: int = 20_000) -> DataFrame:
    """One row with the exact median of each column's values that are not null, under its name.

    A sketch first gives two values that hold the middle between them; of the rows only what lies between them, a share
    of 8 / accuracy apart from ties, meets in one place, as counts of distinct values. The exact aggregate would
    gather every distinct value.
    """
    around = 4.0 / accuracy
    sketch = df.agg(*[F.percentile_approx(c, [0.5 - around, 0.5 + around], accuracy).alias(f"__b{i}") for i, c in enumerate(columns)])
    out = None
    for i, c in enumerate(columns):
        low, high = F.col(f"__b{i}")[0], F.col(f"__b{i}")[1]
        values = df.filter(F.col(c).isNotNull()).select(F.col(c).cast("double").alias("v")).crossJoin(F.broadcast(sketch.select(f"__b{i}")))
        side = F.when(F.col("v") < low, -1).when(F.col("v") > high, 1).otherwise(0)
        counts = values.groupBy(side.alias("side"), F.when(side == 0, F.col("v")).alias("v")).agg(F.count("*").alias("n"))
        inner = F.array_sort(F.collect_list(F.when(F.col("side") == 0, F.struct("v", "n"))))
        one = counts.agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("side") < 0, F.col("n"))), F.lit(0)).alias("below"), inner.alias("inner"))
        # the value at a place: the first whose running count passes it
        at = lambda k: F.aggregate("inner", F.struct(k.cast("long").alias("left"), F.lit(None).cast("double").alias("v")), lambda a, x: F.struct((a["left"] - x["n"]).alias("left"), F.when((a["left"] >= 0) & (a["left"] < x["n"]), x["v"]).otherwise(a["v"]).alias("v")))["v"]
        first, last = F.floor((F.col("n") - 1) / 2) - F.col("below"), F.floor(F.col("n") / 2) - F.col("below")
        row = one.select(((at(first) + at(last)) / 2).alias(c))
        out = row if out is None else out.crossJoin(row)
    return out


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows for each value that is not null, the most frequent first; ties by value."""
    out = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return out.limit(top) if top else out


def shares(df: DataFrame, column: str) -> DataFrame:
    """value_counts with percentages."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))
