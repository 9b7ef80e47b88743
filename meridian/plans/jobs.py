"""Run control: ingestion as one lazy plan with one write, retries, a circuit breaker, and the silver transformation."""

from __future__ import annotations

import json
import logging
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from meridian.operators import privacy
from meridian.operators.identity import resolve
from meridian.operators.mapping import CanonicalDataset, mapper_for, with_ordinal
from meridian.operators.validation import validate
from meridian.sources.storage import BronzeWriter, DatasetCatalog, SilverWriter, schema_fingerprint

log = logging.getLogger(__name__)


class CircuitBreakerOpen(RuntimeError):
    pass


class JsonFormatter(logging.Formatter):
    """One JSON object for each record."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"timestamp": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage(), "module": record.module, "funcName": record.funcName, "lineNo": record.lineno}
        if record.exc_info:
            out["exception"] = self.formatException(record.exc_info)
        return json.dumps(out)


def get_logger(name: str) -> logging.Logger:
    logger = logging.getLogger(name)
    if not logger.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(JsonFormatter())
        logger.addHandler(handler)
    logger.setLevel(os.environ.get("LOG_LEVEL", "INFO"))
    return logger


@dataclass
class Ingestion:
    """A source and what becomes of it. ``fetch`` gives raw data, ``parse`` a DataFrame; the other parts are optional."""

    source_type: str
    fetch: Callable[[], object]
    parse: Callable[[object], DataFrame] = lambda raw: raw
    salt: str | None = None
    manifest: dict | None = None
    validates: bool = True
    bronze: BronzeWriter | None = None
    catalog: DatasetCatalog | None = None
    quarantine: str | None = None
    max_retries: int = 3
    retry_backoff: float = 5.0
    failures: int = field(default=0, init=False)

    def run(self, metadata: dict | None = None, sleep: Callable[[float], None] = time.sleep) -> dict:
        """fetch, parse, hash, validate, write, register; failed attempts wait longer each time and count towards the
        breaker, which a success resets. A later attempt repeats nothing that has been written: rejected rows replace
        those of the same run, and once bronze is written only the registration is tried again."""
        if self.failures >= self.max_retries:
            raise CircuitBreakerOpen(f"{self.source_type}: {self.failures} attempts failed")
        run_id, done = uuid.uuid4().hex, {}
        for attempt in range(1, self.max_retries + 1):
            try:
                out = self._once(metadata or {}, run_id, done)
            except Exception as e:
                self.failures += 1
                log.warning("%s: attempt %d failed: %s", self.source_type, attempt, e)
                if attempt == self.max_retries:
                    raise
                sleep(self.retry_backoff * attempt)
            else:
                self.failures = 0
                return out
        raise AssertionError

    def _once(self, metadata: dict, run_id: str, done: dict) -> dict:
        """done: what earlier attempts of this run have written."""
        if "bronze" in done:
            return self._registered(done)
        df = self.parse(self.fetch())
        out: dict = {"source_type": self.source_type}
        if self.salt is not None:
            fields = privacy.personal_columns(self.source_type, df.columns, self.manifest or privacy.PERSONAL)
            df, out["audit"] = privacy.anonymize(df, fields, self.salt)
        if self.validates:
            result = validate(df, self.source_type)
            df = result.valid
            out["validation"] = result.stats
            if self.quarantine:
                result.rejected.write.mode("overwrite").parquet(f"{self.quarantine}/{self.source_type}/run={run_id}")
        if self.bronze is not None:
            short = self.source_type.split("_", 1)
            told = {"source": short[0], "subsystem": short[-1], "source_type": self.source_type, "source_file": "stream"} | metadata
            out["bronze"] = self.bronze.write(df, told)
            done.update(out, fingerprint=schema_fingerprint(df))
            return self._registered(done)
        out["data"] = df
        return out

    def _registered(self, done: dict) -> dict:
        out = {k: v for k, v in done.items() if k != "fingerprint"}
        if self.catalog is not None:
            out["dataset_id"] = self.catalog.register_dataset(self.source_type, out["bronze"]["table_path"], out["bronze"]["rows_written"], done["fingerprint"], "audit" in out)
        return out


@dataclass
class SilverPipeline:
    spark: SparkSession
    salt: str
    silver: SilverWriter | None = None
    catalog: DatasetCatalog | None = None

    def transform_dataframe(self, df: DataFrame, source_type: str) -> tuple[CanonicalDataset, dict]:
        """The canonical tables, and per-table write results if there is a writer: then the source is read and its rows
        are numbered once, so that "first" is the same row in every table, and the tables fan out from that."""
        mapped = lambda rows: resolve(mapper_for(source_type, self.salt)(rows), self.salt)
        if self.silver is None:
            return mapped(df), {}
        base = f"{self.silver.path}/_base/{uuid.uuid4().hex}"
        numbered = with_ordinal(df)
        # a column of nulls only has no type that a file knows
        untyped = {f.name: F.col(f"`{f.name}`").cast("string") for f in numbered.schema if isinstance(f.dataType, NullType)}
        numbered = numbered.withColumns(untyped)
        numbered.write.parquet(base)
        try:
            results = self.silver.write_canonical_dataset(mapped(self.spark.read.schema(numbered.schema).parquet(base)))
        finally:
            self.silver.format.remove(self.spark, base)
        if self.catalog is not None:
            rows = sum(r["rows_written"] for r in results.values())
            self.catalog.register_dataset(f"silver_{source_type}", self.silver.path, rows, schema_fingerprint(df), True, {k: r["rows_written"] for k, r in results.items()})
        return mapped(df), results

    def transform_bronze_table(self, path: str, source_type: str, year: int | None = None, month: int | None = None) -> dict:
        """A bronze table, or one month of it: the filter prunes partitions. A missing table is skipped."""
        fmt = self.silver.format if self.silver else None
        if fmt is not None and not fmt.exists(self.spark, path):
            return {"skipped": True}
        df = self.spark.read.parquet(path) if fmt is None else fmt.read(self.spark, path)
        if year is not None:
            df = df.filter(F.col("year") == year)
        if month is not None:
            df = df.filter(F.col("month") == month)
        return self.transform_dataframe(df, source_type)[1]


def merge(*parts: CanonicalDataset) -> CanonicalDataset:
    """The union of datasets, table by table and by column name."""
    from functools import reduce

    tables = {}
    for name in CanonicalDataset().tables():
        found = [t for p in parts if (t := getattr(p, name)) is not None]
        tables[name] = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else None
    return replace(CanonicalDataset(), **tables)
