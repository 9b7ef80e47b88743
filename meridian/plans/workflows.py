"""Named jobs: what a scheduler calls, from a source to bronze and, where there is a mapper, on to silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from meridian.plans.jobs import Ingestion, SilverPipeline
from meridian.sources import dbf, fhir, readers
from meridian.sources.storage import BronzeWriter, DatasetCatalog, SilverWriter

Fetch = Callable[[SparkSession, str | None], DataFrame]


def _dbf(spark: SparkSession, path: str | None) -> DataFrame:
    """A DBF file or a CSV or JSON export of it."""
    if path is None:
        raise FileNotFoundError("this source needs a file")
    if not path.lower().endswith((".dbf", ".dbc")):
        return readers.read_records(spark, path)
    spark.dataSource.register(dbf.DbfSource)
    return readers.canonical_headers(spark.read.format("dbf").load(path))


@dataclass(frozen=True)
class Workflow:
    source_type: str
    schedule: str
    fetch: Fetch
    silver: bool
    #: Stands in if the source fails, marked as such.
    fallback: Callable[[SparkSession], DataFrame] | None = None


WORKFLOWS = {
    "hospital": Workflow("datasus_sih", "@monthly", _dbf, True),
    "ambulatory": Workflow("datasus_sia", "@monthly", _dbf, False),
    "facilities": Workflow("datasus_cnes", "@monthly", _dbf, True),
    "notifications": Workflow("datasus_sinan", "@weekly", _dbf, False),
    "primary_care": Workflow("datasus_sisab", "@monthly", lambda s, p: readers.read_records(s, p) if p else readers.sample_primary_care(s), False, readers.sample_primary_care),
    "regulation": Workflow("sisreg_regulation", "@weekly", readers.referrals_or_sample, True, readers.sample_referrals),
    "health_plans": Workflow("ans_data", "@monthly", readers.plans_or_sample, True, readers.sample_plans),
    "fhir": Workflow("fhir_synthetic", "@once", lambda s, p: fhir.flatten(fhir.bundles(s, 50, 3)), True),
}


def run(spark: SparkSession, name: str, lakehouse: str, salt: str, path: str | None = None, year: int = 2025, month: int = 1, **retry) -> dict:
    """One run of a job: bronze stats, silver stats, and whether the source or its stand-in was read.

    FHIR silver is mapped from the rows before the gate hashes raw_json, which the mapper reads; all others from bronze.
    """
    job = WORKFLOWS[name]
    bronze, catalog = BronzeWriter(f"{lakehouse}/bronze"), DatasetCatalog(f"{lakehouse}/catalog")
    status = "success"
    fetched: list[DataFrame] = []

    def fetch() -> DataFrame:
        nonlocal status
        if job.fallback is None:
            df = job.fetch(spark, path)
        else:
            df, status = readers.with_fallback(lambda: job.fetch(spark, path), lambda: job.fallback(spark))
        fetched[:] = [df]
        return df

    out = Ingestion(job.source_type, fetch, salt=salt, bronze=bronze, catalog=catalog, quarantine=f"{lakehouse}/quarantine", **retry).run({"source_file": path or "sample", "year": year, "month": month})
    out["status"] = status
    if job.silver:
        pipeline = SilverPipeline(spark, salt, SilverWriter(f"{lakehouse}/silver"), catalog)
        if "fhir" in job.source_type:
            out["silver"] = pipeline.transform_dataframe(fetched[0], job.source_type)[1]
        else:
            out["silver"] = pipeline.transform_bronze_table(out["bronze"]["table_path"], job.source_type, year, month)
    return out
