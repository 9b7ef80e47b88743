"""Tables in the lakehouse: bronze and silver writes, the catalogue, checkpoints, export."""

from __future__ import annotations

import json
import os
import sqlite3
import time
import uuid
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meridian.operators.mapping import CanonicalDataset


def hadoop(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class TableFormat:
    """Partitioned Parquet; a subclass may put another format behind the same calls."""

    name = "parquet"

    def append(self, df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> None:
        df.write.format(self.name).mode("append").partitionBy(*partitions).save(path)

    def overwrite(self, df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> None:
        """Replaces the partitions that df has rows for (all of an unpartitioned table)."""
        df.write.format(self.name).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).save(path)

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.format(self.name).option("mergeSchema", True).load(path)

    def exists(self, spark: SparkSession, path: str) -> bool:
        """Whether there is a data file; a folder that holds none is no table."""
        fs, p = hadoop(spark, path)
        if not fs.exists(p):
            return False
        files = fs.listFiles(p, True)
        while files.hasNext():
            if not files.next().getPath().getName().startswith(("_", ".")):
                return True
        return False

    def remove(self, spark: SparkSession, path: str) -> None:
        fs, p = hadoop(spark, path)
        fs.delete(p, True)


PARQUET = TableFormat()


class CommitFormat(TableFormat):
    """Parquet behind a log of commits: every write goes to a folder of its own, and one small file, made under the next
    number or not at all, makes it part of the table. A write that fails is never seen, not even in part; of two writers
    that want the same number one takes the next. ``read`` may ask for the table as of a commit."""

    tries = 100

    def _commits(self, spark: SparkSession, path: str) -> list[dict]:
        log = JsonFolder(f"{path}/_commits", spark)
        return [log.read(n) for n in log.names()]

    def _commit(self, df: DataFrame, path: str, partitions: tuple[str, ...], replaces: bool) -> None:
        spark = df.sparkSession
        folder = f"data-{uuid.uuid4().hex}"
        df.write.format(self.name).partitionBy(*partitions).save(f"{path}/{folder}")
        log = JsonFolder(f"{path}/_commits", spark)
        for _ in range(self.tries):
            number = len(log.names())
            if log.create(f"{number:010d}", {"folder": folder, "replaces": replaces, "partitions": list(partitions)}):
                return
        raise OSError(f"{path}: no commit in {self.tries} tries")

    def append(self, df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> None:
        self._commit(df, path, partitions, False)

    def overwrite(self, df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> None:
        """Replaces the whole table; what it was can still be read as of an earlier commit."""
        self._commit(df, path, partitions, True)

    def read(self, spark: SparkSession, path: str, commit: int | None = None) -> DataFrame:
        commits = self._commits(spark, path)[: None if commit is None else commit + 1]
        first = max((i for i, c in enumerate(commits) if c["replaces"]), default=0)
        folders = [f"{path}/{c['folder']}" for c in commits[first:] if super(CommitFormat, self).exists(spark, f"{path}/{c['folder']}")]
        if not folders:
            raise FileNotFoundError(f"{path} has no rows")
        parts = [spark.read.format(self.name).option("mergeSchema", True).load(f) for f in folders]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def exists(self, spark: SparkSession, path: str) -> bool:
        commits = self._commits(spark, path)
        first = max((i for i, c in enumerate(commits) if c["replaces"]), default=0)
        return any(super(CommitFormat, self).exists(spark, f"{path}/{c['folder']}") for c in commits[first:])


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The row count comes with the write, not from a second run of the plan."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


class BronzeWriter:
    def __init__(self, lakehouse_path: str, table_format: TableFormat = PARQUET):
        self.path, self.format = lakehouse_path.rstrip("/"), table_format

    def write(self, df: DataFrame, metadata: dict, idempotent: bool = False) -> dict:
        """Appends to source/subsystem, partitioned by year and month of the data where it has them, else of now. Where
        nothing comes no table is made."""
        began, now = time.monotonic(), datetime.now(timezone.utc)
        where = f"{self.path}/{metadata['source']}/{metadata['subsystem']}"
        out = df.withColumns({"_ingested_at": F.lit(now.isoformat()), "_source_type": F.lit(metadata["source_type"]), "_source_file": F.lit(metadata.get("source_file", "unknown"))})
        for name, value in (("year", metadata.get("year", now.year)), ("month", metadata.get("month", now.month))):
            if name not in out.columns:
                out = out.withColumn(name, F.lit(int(value)))
        out, seen = _counted(out)
        there = self.format.exists(df.sparkSession, where)
        (self.format.overwrite if idempotent else self.format.append)(out, where, ("year", "month"))
        if not seen.get["n"] and not there:
            self.format.remove(df.sparkSession, where)
        return {"rows_written": seen.get["n"], "table_path": where, "duration_seconds": time.monotonic() - began}


class SilverWriter:
    def __init__(self, silver_base_path: str, table_format: TableFormat = PARQUET):
        self.path, self.format = silver_base_path.rstrip("/"), table_format

    def write_table(self, df: DataFrame | None, name: str) -> dict:
        """The plan runs once: whether there were rows is told by the write."""
        if df is None:
            return {"status": "skipped_empty", "rows_written": 0}
        where = f"{self.path}/{name}"
        there = self.format.exists(df.sparkSession, where)
        out, seen = _counted(df)
        self.format.append(out, where)
        if seen.get["n"]:
            return {"status": "success", "rows_written": seen.get["n"]}
        if not there:
            self.format.remove(df.sparkSession, where)
        return {"status": "skipped_empty", "rows_written": 0}

    def write_canonical_dataset(self, ds: CanonicalDataset) -> dict[str, dict]:
        return {name: self.write_table(df, name) for name, df in ds.tables().items()}


def schema_fingerprint(df: DataFrame) -> str:
    import hashlib

    return hashlib.md5(df.schema.json().encode()).hexdigest()


class JsonFolder:
    """Small JSON files in a folder: a local one, or any that Hadoop knows by a scheme (through the active session)."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        self.path, self.spark = path.rstrip("/"), spark

    def _fs(self) -> tuple:
        spark = self.spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        return (spark, *hadoop(spark, self.path))

    def create(self, name: str, row: dict) -> bool:
        """Writes a file that is not there yet; false if it is. A reader may see it empty for a moment and waits."""
        data = json.dumps(row)
        if "://" not in self.path:
            folder = Path(self.path)
            folder.mkdir(parents=True, exist_ok=True)
            draft = folder / f".{name}.{uuid.uuid4().hex}"
            draft.write_text(data)
            try:
                os.link(draft, folder / f"{name}.json")  # fails if the name is taken
            except FileExistsError:
                return False
            finally:
                draft.unlink()
            return True
        spark, fs, _ = self._fs()
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}.json")
        try:
            out = fs.create(path, False)
        except Exception as e:
            if fs.exists(path):
                return False
            raise OSError(f"{path} could not be made") from e
        try:
            out.write(bytearray(data.encode()))
        finally:
            out.close()
        return True

    def write(self, name: str, row: dict) -> None:
        """Whole or not at all: a draft takes the file's name when it is complete."""
        if "://" not in self.path:
            folder = Path(self.path)
            folder.mkdir(parents=True, exist_ok=True)
            draft = folder / f".{name}.{uuid.uuid4().hex}"
            draft.write_text(json.dumps(row))
            draft.replace(folder / f"{name}.json")
            return
        spark, fs, _ = self._fs()
        of = lambda n: spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}")
        draft, last = of(f".{name}.{uuid.uuid4().hex}"), of(f"{name}.json")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()
        if not fs.rename(draft, last):
            fs.delete(last, False)
            if not fs.rename(draft, last):
                raise OSError(f"{self.path}/{name}.json could not be written")

    def read(self, name: str) -> dict | None:
        if "://" not in self.path:
            p = Path(self.path) / f"{name}.json"
            return json.loads(p.read_text()) if p.exists() else None
        spark, fs, _ = self._fs()
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}.json")
        if not fs.exists(p):
            return None
        for wait in (0.0, 0.1, 0.5, 2.0):  # a writer may just have made it
            time.sleep(wait)
            stream = fs.open(p)
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text:
                return json.loads(text)
        raise OSError(f"{p} is empty")

    def names(self) -> list[str]:
        if "://" not in self.path:
            found = [p.name for p in Path(self.path).glob("*.json")]
        else:
            _, fs, p = self._fs()
            found = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and not n.startswith("."))


class DatasetCatalog:
    """One JSON file for each dataset in a folder: registering never rewrites what others registered."""

    def __init__(self, path: str):
        self.folder = JsonFolder(path)

    def register_dataset(self, source_type: str, partition_path: str, row_count: int, schema_fingerprint: str, pii_anonymized: bool = True, extra_metadata: dict | None = None) -> str:
        dataset_id, now = str(uuid.uuid4()), datetime.now(timezone.utc).isoformat()
        row = {"dataset_id": dataset_id, "source_type": source_type, "partition_path": partition_path, "row_count": row_count, "schema_fingerprint": schema_fingerprint, "ingested_at": now, "pii_anonymized": pii_anonymized, "extra_metadata": extra_metadata or {}}
        self.folder.write(dataset_id, row)
        return dataset_id

    def list_datasets(self) -> list[dict]:
        rows = (self.folder.read(n) for n in self.folder.names())
        return sorted((r for r in rows if r is not None), key=lambda r: (r["ingested_at"], r["dataset_id"]))

    def get_dataset(self, dataset_id: str) -> dict | None:
        return self.folder.read(dataset_id)

    def get_datasets_by_source(self, source_type: str) -> list[dict]:
        return [r for r in self.list_datasets() if r["source_type"] == source_type]


class Checkpoints:
    """Ingestion state, one JSON file for each source type."""

    def __init__(self, state_dir: str):
        self.folder = JsonFolder(state_dir)

    def save(self, source_type: str, state: dict) -> None:
        self.folder.write(f"{source_type}_state", state)

    def load(self, source_type: str) -> dict | None:
        return self.folder.read(f"{source_type}_state")


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def export_sqlite(tables: dict[str, DataFrame], path: str, batch: int = 5000) -> dict[str, int]:
    """Replaces the tables in a SQLite file; rows come partition by partition, so the driver holds one batch. Values
    that SQLite does not know go as text, nulls as nulls."""
    from itertools import islice

    out = {}
    with sqlite3.connect(path) as db:
        for name, df in tables.items():
            plain = df.select(*[F.col(f"`{c}`") if t in ("int", "bigint", "double", "string", "smallint", "tinyint", "float") else F.col(f"`{c}`").cast("string").alias(c) for c, t in df.dtypes])
            columns = ", ".join(f'"{c}"' for c in plain.columns)
            db.execute(f'DROP TABLE IF EXISTS "{name}"')
            db.execute(f'CREATE TABLE "{name}" ({columns})')
            rows, n = plain.toLocalIterator(prefetchPartitions=True), 0
            while part := [tuple(r) for r in islice(rows, batch)]:
                db.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(plain.columns))})', part)
                n += len(part)
            out[name] = n
    return out


def sqlite_tables(path: str) -> list[str]:
    with sqlite3.connect(path) as db:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]


def read_sqlite(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A small export table back as a DataFrame of text columns."""
    with sqlite3.connect(path) as db:
        found = db.execute(f'SELECT * FROM "{name}"')
        columns = [c[0] for c in found.description]
        rows = [tuple(None if v is None else str(v) for v in r) for r in found]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def inspect(df: DataFrame, by: str | None = None, hashed: str | None = None, most: int = 1000) -> dict:
    """Columns, rows, rows by a column's values (the ``most`` most frequent ones) and the share of a column that looks
    hashed, in one pass where it can."""
    from meridian.functions.text import is_hash

    aggs = [F.count(F.lit(1)).alias("n")] + ([F.avg(is_hash(F.col(hashed)).cast("int")).alias("h")] if hashed else [])
    row = df.agg(*aggs).first()
    out = {"columns": df.columns, "rows": row["n"]}
    if hashed:
        out["hashed_share"] = row["h"]
    if by:
        out["distribution"] = {r[by]: r["count"] for r in df.groupBy(by).count().orderBy(F.desc("count"), by).limit(most).collect()}
    return out
