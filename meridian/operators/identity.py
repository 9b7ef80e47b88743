"""Master identities of patients and facilities."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.mapping import CanonicalDataset


def master_patient_id(patient_id: Column, birth_hash: Column, municipality: Column, salt: str, null_as_text: bool = False) -> Column:
    """From birth hash and municipality if both are there, else from the id itself.

    null_as_text: take a null municipality as the word None, as an older key did.
    """
    place = F.coalesce(municipality, F.lit("None")) if null_as_text else municipality
    strong = (F.length(birth_hash) >= 16) & (F.length(place) > 0)
    short = lambda *parts: F.concat(F.lit("mpi_"), F.substring(F.sha2(F.concat_ws("_", *parts, F.lit(salt)), 256), 1, 16))
    return F.when(strong, short(birth_hash, place)).otherwise(short(patient_id))


def resolve(ds: CanonicalDataset, salt: str) -> CanonicalDataset:
    """Adds master ids. A master id that a mapper gave is never derived again, so dimension and facts agree."""
    patients = ds.dim_patients
    if patients is not None:
        own = master_patient_id(F.col("patient_id"), F.col("birth_date_hash"), F.col("municipality_code"), salt)
        have = F.col("patient_master_id") if "patient_master_id" in patients.columns else F.lit(None).cast("string")
        patients = patients.withColumn("patient_master_id", F.coalesce(have, own))
    out = {"dim_patients": patients}
    for name in ("fct_encounters", "fct_conditions", "fct_procedures"):
        facts = getattr(ds, name)
        if facts is not None:
            out[name] = enrich(facts, patients, salt)
    if ds.fct_referrals is not None and "patient_id" in ds.fct_referrals.columns and "patient_master_id" not in ds.fct_referrals.columns:
        out["fct_referrals"] = enrich(ds.fct_referrals, patients, salt)
    if ds.dim_organizations is not None:
        out["dim_organizations"] = ds.dim_organizations.withColumn("organization_master_id", F.col("organization_id"))
    return replace(ds, **out)


def enrich(facts: DataFrame, patients: DataFrame | None, salt: str) -> DataFrame:
    """facts with the patients' master ids; without a match an id from the patient_id alone."""
    nothing = F.lit(None).cast("string")
    alone = master_patient_id(F.col("patient_id"), nothing, nothing, salt)
    if patients is None:
        return facts.withColumn("patient_master_id", alone)
    ids = patients.select("patient_id", F.col("patient_master_id").alias("__mpi"))
    joined = facts.drop("patient_master_id").join(ids, "patient_id", "left")
    return joined.withColumn("patient_master_id", F.coalesce("__mpi", alone)).drop("__mpi").select(*[c for c in facts.columns if c != "patient_master_id"], "patient_master_id")
