"""Compares registered queries with their SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows(columns: list[str], found) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def difference(df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, null if nothing does."""
    found = db.sql(sql)
    if sorted(df.columns) != sorted(found.columns):
        return f"columns {sorted(df.columns)} and {sorted(found.columns)}"
    kinds = dict(zip(found.columns, map(str, found.types)))
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            return f"{name} is {kind} and {kinds[name]}"
    a, b = rows(df.columns, df.collect()), rows(found.columns, found.fetchall())
    if a != b:
        first = next((p for p in zip(a, b) if p[0] != p[1]), None)
        return f"{len(a)} and {len(b)} rows; first difference {first}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or sql:
        try:
            said = difference(queries[name](spark, sf_dir), connect(sf_dir), sql[name])
        except Exception as e:
            said = str(e)[:600]
        bad += said is not None
        print(name, "ok" if said is None else f"DIFFERS: {said}", flush=True)
    print(f"{bad} differ")
    sys.exit(bool(bad))
