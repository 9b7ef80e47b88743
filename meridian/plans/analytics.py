"""Analytic reports over the canonical tables, each a function from DataFrames to a DataFrame.

Null keys are left out of groups; every limit has a unique order; hospitals' and patients' dimensions are reduced to
one row a key before a join, so no join fans out. Encounters are counted, not joined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions import terminology as term
from meridian.functions.text import decimal_number, differs, share
from meridian.operators.relational import keep_first, medians, shares, total, value_counts


def expired() -> Column:
    """A missing disposition is none."""
    return F.coalesce(F.col("discharge_disposition") == "expired", F.lit(False))


#: Conditions that primary care can keep out of hospital: fixed values.
AVOIDABLE = ("I10", "I11", "I15", "E10", "E11", "E14", "J45")


def _rate(flag: Column) -> Column:
    return share(F.count_if(flag), F.count("*"))


def _hospitals() -> Column:
    """A patient's different hospitals: a set for each patient, where a distinct count would shuffle every row once more."""
    return F.size(F.collect_set("organization_id")).cast("long")


def _mean(c: str) -> Column:
    return F.try_divide(total(c), F.count(c))


def global_kpis(encounters: DataFrame) -> DataFrame:
    cost, days = "total_cost_brl", "length_of_stay_days"
    sums = encounters.agg(F.count("*").alias("admissions"), total(cost).alias("total_cost"), _mean(cost).alias("mean_cost"), F.avg(days).alias("mean_days"), F.count_if(expired()).alias("deaths"), _rate(expired()).alias("mortality_pct"))
    middle = medians(encounters, [cost, days]).select(F.col(cost).alias("median_cost"), F.col(days).alias("median_days"))
    return sums.crossJoin(middle)  # single rows


def class_share(encounters: DataFrame) -> DataFrame:
    return shares(encounters, "encounter_class")


def top_chapters(encounters: DataFrame, k: int = 10) -> DataFrame:
    return value_counts(encounters, "primary_diagnosis_chapter", k)


def lethal_diagnoses(encounters: DataFrame, least: int = 10, k: int = 10) -> DataFrame:
    e = encounters.filter("primary_diagnosis_code is not null and primary_diagnosis_chapter is not null").groupBy("primary_diagnosis_code", "primary_diagnosis_chapter")
    e = e.agg(F.count("*").alias("cases"), F.count_if(expired()).alias("deaths"), _mean("total_cost_brl").alias("mean_cost"), F.avg("length_of_stay_days").alias("mean_days"), _rate(expired()).alias("lethality_pct"))
    top = e.filter(F.col("cases") >= least).orderBy(F.desc("lethality_pct"), F.desc("cases"), "primary_diagnosis_code", "primary_diagnosis_chapter").limit(k)
    return top.withColumn("label", term.diagnosis_label(F.col("primary_diagnosis_code")))


def costly_diagnoses(encounters: DataFrame, k: int = 10) -> DataFrame:
    e = encounters.filter("primary_diagnosis_code is not null").groupBy("primary_diagnosis_code")
    chapter = F.min_by("primary_diagnosis_chapter", F.when(F.col("primary_diagnosis_chapter").isNotNull(), F.struct("period_start", "encounter_id")))
    out = e.agg(total("total_cost_brl").alias("total_cost"), F.count("*").alias("cases"), _mean("total_cost_brl").alias("mean_cost"), chapter.alias("chapter"))
    return out.orderBy(F.desc("total_cost"), "primary_diagnosis_code").limit(k)


def hospital_concentration(encounters: DataFrame, k: int = 10) -> DataFrame:
    out = encounters.filter("organization_id is not null").groupBy("organization_id").agg(F.count("*").alias("admissions"), total("total_cost_brl").alias("total_cost"), F.count_if(expired()).alias("deaths"), F.avg("length_of_stay_days").alias("mean_days"))
    out = out.withColumn("mortality_pct", share(F.col("deaths"), F.col("admissions"))).orderBy(F.desc("admissions"), "organization_id").limit(k)
    return out.withColumn("hospital", term.hospital_label(F.col("organization_id")))


def _patients(patients: DataFrame) -> DataFrame:
    """One row for each master id."""
    return keep_first(patients.select("patient_master_id", "gender", "municipality_code", "patient_id"), ["patient_master_id"], ["patient_id"]).drop("patient_id")


def with_patients(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    return encounters.join(_patients(patients), "patient_master_id", "left")


def demography(encounters: DataFrame, patients: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shares of the genders, and the municipalities with most admissions."""
    joined = with_patients(encounters, patients)
    places = value_counts(joined, "municipality_code", 5).withColumn("municipality", term.municipality_label(F.col("municipality_code")))
    return shares(joined, "gender"), places


def readmissions(encounters: DataFrame) -> DataFrame:
    per = encounters.filter("patient_master_id is not null").groupBy("patient_master_id").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("patients"), F.count_if(F.col("n") > 1).alias("readmitted"), _rate(F.col("n") > 1).alias("readmitted_pct"), F.max("n").alias("most"))


def journeys(encounters: DataFrame) -> DataFrame:
    """Encounters with their step in the patient's journey."""
    w = Window.partitionBy("patient_master_id").orderBy(F.col("period_start").asc_nulls_last(), "encounter_id")
    return encounters.filter("patient_master_id is not null").withColumn("step", F.row_number().over(w))


def super_user(encounters: DataFrame) -> DataFrame:
    """The journey of the patient who cost the most."""
    top = encounters.filter("patient_master_id is not null").groupBy("patient_master_id").agg(total("total_cost_brl").alias("patient_total")).orderBy(F.desc("patient_total"), "patient_master_id").limit(1)
    return journeys(encounters.join(F.broadcast(top), "patient_master_id"))


def multi_hospital(encounters: DataFrame) -> DataFrame:
    """Patients of several hospitals; the hospitals stand in the order in which they were first seen."""
    seen = F.array_sort(F.collect_list(F.struct("period_start", "encounter_id", "organization_id")))
    out = encounters.filter("patient_master_id is not null").groupBy("patient_master_id").agg(F.count("*").alias("encounters"), seen.alias("seen"))
    hospitals = F.array_compact(F.array_distinct(F.transform("seen", lambda x: x["organization_id"])))
    out = out.select("patient_master_id", "encounters", hospitals.alias("hospital_list")).withColumn("hospitals", F.size("hospital_list").cast("long"))
    return out.filter("hospitals > 1").orderBy(F.desc("hospitals"), F.desc("encounters"), "patient_master_id")


def journey_details(encounters: DataFrame, conditions: DataFrame, procedures: DataFrame) -> DataFrame:
    """Journeys with the codes of each encounter; the placeholder code 0000 is dropped."""
    cs = conditions.filter("code <> '0000'").groupBy("encounter_id").agg(F.array_sort(F.collect_list("code")).alias("condition_codes"))
    ps = procedures.groupBy("encounter_id").agg(F.array_sort(F.collect_list("code")).alias("procedure_codes"))
    return journeys(encounters).join(cs, "encounter_id", "left").join(ps, "encounter_id", "left")


def expired_journeys(encounters: DataFrame) -> DataFrame:
    """Patients who died, with more than one encounter or hospital."""
    died = encounters.filter(expired()).select("patient_master_id").distinct()
    per = encounters.join(died, "patient_master_id", "left_semi").groupBy("patient_master_id").agg(F.count("*").alias("encounters"), _hospitals().alias("hospitals"))
    return per.filter("encounters > 1 or hospitals > 1").orderBy(F.desc("hospitals"), F.desc("encounters"), "patient_master_id")


def alive_then_expired(encounters: DataFrame, k: int | None = 1) -> DataFrame:
    """Patients whose first encounter ended alive and whose last one did not, over several hospitals."""
    at = F.struct("period_start", "encounter_id")
    per = encounters.filter("patient_master_id is not null").groupBy("patient_master_id").agg(F.min_by("discharge_disposition", at).alias("first"), F.max_by("discharge_disposition", at).alias("last"), _hospitals().alias("hospitals"))
    out = per.filter("first = 'discharged_alive' and last = 'expired' and hospitals > 1").orderBy("patient_master_id")
    return out.limit(k) if k else out


def care_pyramid(primary: DataFrame, ambulatory: DataFrame, encounters: DataFrame) -> DataFrame:
    """Volumes and spending of the three levels; the crossed sides are single rows."""
    a = primary.agg(total(decimal_number(F.col("QT_ATENDIMENTOS"))).alias("primary_visits"))
    b = ambulatory.agg(total(decimal_number(F.col("PA_QTDPRO"))).alias("ambulatory_procedures"), total(decimal_number(F.col("PA_VALPRO"))).alias("ambulatory_cost"))
    c = encounters.agg(F.count("*").alias("admissions"), total("total_cost_brl").alias("hospital_cost"))
    out = a.crossJoin(b).crossJoin(c)
    return out.withColumns({"visits_per_admission": F.col("primary_visits") / F.greatest(F.lit(1), "admissions"), "ambulatory_cost_pct": share(F.col("ambulatory_cost"), F.col("ambulatory_cost") + F.col("hospital_cost"))})


def occupancy(encounters: DataFrame, organizations: DataFrame, days_in_period: int = 31) -> DataFrame:
    used = encounters.groupBy("organization_id").agg(F.sum("length_of_stay_days").alias("days"), F.count("*").alias("admissions"))
    beds = organizations.filter("bed_capacity > 0").groupBy("organization_id").agg(F.max("bed_capacity").alias("beds"))
    out = used.join(beds, "organization_id")
    return out.withColumns({"occupancy_pct": share(F.col("days"), F.col("beds") * days_in_period), "turnover": F.col("admissions") / F.col("beds")}).orderBy(F.desc("occupancy_pct"), "organization_id")


def dengue_funnel(notifications: DataFrame, ambulatory: DataFrame, encounters: DataFrame) -> DataFrame:
    a = notifications.agg(F.count("*").alias("notified"))
    code = F.col("PA_PROC_ID")
    b = ambulatory.agg(F.coalesce(total(F.when(code.startswith("0201") | code.startswith("0202"), decimal_number(F.col("PA_QTDPRO")))), F.lit(0.0)).alias("exams"))
    dx = F.col("primary_diagnosis_code")
    c = encounters.agg(F.count_if(dx.startswith("A90") | dx.startswith("A91")).alias("admitted"))
    return a.crossJoin(b).crossJoin(c).withColumn("admitted_pct", F.col("admitted") * 100.0 / F.greatest(F.lit(1), "notified"))


def avoidable(encounters: DataFrame, codes: tuple[str, ...] = AVOIDABLE) -> DataFrame:
    hit = F.coalesce(F.substring("primary_diagnosis_code", 1, 3).isin(*codes), F.lit(False))
    return encounters.agg(F.count_if(hit).alias("avoidable"), _rate(hit).alias("avoidable_pct"), total(F.when(hit, F.col("total_cost_brl")).otherwise(0.0)).alias("avoidable_cost"))


def migration(encounters: DataFrame, patients: DataFrame, organizations: DataFrame) -> DataFrame:
    """Encounters with home and hospital municipality; a hospital without a known place counts as away."""
    orgs = keep_first(organizations.select("organization_id", F.col("municipality_code").alias("hospital_place")), ["organization_id"], ["hospital_place"])
    joined = with_patients(encounters, patients).withColumnRenamed("municipality_code", "home_place").join(orgs, "organization_id", "left")
    return joined.withColumn("travelled", differs(F.col("home_place"), F.col("hospital_place")))


def migration_rate(moved: DataFrame) -> DataFrame:
    return moved.agg(F.count_if("travelled").alias("travelled"), F.count("*").alias("encounters"), _rate(F.col("travelled")).alias("travelled_pct"))


def migration_routes(moved: DataFrame, k: int = 8) -> DataFrame:
    return migration_flows(moved).orderBy(F.desc("n"), "home_place", "hospital_place").limit(k)


def migration_matrix(moved: DataFrame, places: list[str]) -> DataFrame:
    """Travellers by home and by hospital, where both are known: a column for each of the places, which pivot needs to know."""
    return moved.filter("travelled and home_place is not null and hospital_place is not null").groupBy("home_place").pivot("hospital_place", places).count().na.fill(0)


def migration_flows(moved: DataFrame) -> DataFrame:
    """The same as rows, for any number of places."""
    return moved.filter("travelled and home_place is not null and hospital_place is not null").groupBy("home_place", "hospital_place").agg(F.count("*").alias("n"))


def birth_modes(encounters: DataFrame) -> DataFrame:
    dx = F.col("primary_diagnosis_code")
    normal, cesarean = F.count_if(dx == "O80.0"), F.count_if(dx.startswith("O82") | dx.startswith("O84"))
    return encounters.agg(normal.alias("normal"), cesarean.alias("cesarean"), (cesarean * 100.0 / F.greatest(F.lit(1), normal + cesarean)).alias("cesarean_pct"))


def long_stays(encounters: DataFrame, days: int = 15) -> DataFrame:
    long = F.coalesce(F.col("length_of_stay_days") > days, F.lit(False))
    cost = total(F.when(long, F.col("total_cost_brl")).otherwise(0.0))
    return encounters.agg(F.count_if(long).alias("long_stays"), _rate(long).alias("long_pct"), cost.alias("long_cost"), share(cost, total("total_cost_brl")).alias("long_cost_pct"))


def top_ambulatory(ambulatory: DataFrame, k: int = 10) -> DataFrame:
    return value_counts(ambulatory, "PA_PROC_ID", k).withColumn("label", term.procedure_label(F.col("PA_PROC_ID")))


def age_bands(rows: DataFrame, age: str = "IDADE") -> DataFrame:
    """Cost and mortality by age in (0, 12], (12, 19], (19, 59], (59, 120]; other ages are left out."""
    a = F.col(age).try_cast("double")
    band, order = F.lit(None).cast("string"), F.lit(None).cast("int")
    for i, (low, high) in enumerate(((0, 12), (12, 19), (19, 59), (59, 120))):
        inside = (a > low) & (a <= high)
        band, order = F.when(inside, f"({low}, {high}]").otherwise(band), F.when(inside, i).otherwise(order)
    out = rows.withColumns({"band": band, "band_order": order}).filter("band is not null").groupBy("band", "band_order")
    return out.agg(F.count("*").alias("n"), _mean("total_cost_brl").alias("mean_cost"), _rate(expired()).alias("mortality_pct")).orderBy("band_order")


def complications(encounters: DataFrame, prefix: str = "T88") -> DataFrame:
    return encounters.filter(F.col("primary_diagnosis_code").startswith(prefix)).select("encounter_id", "patient_id", "organization_id", "primary_diagnosis_code", "total_cost_brl")


def dispositions(encounters: DataFrame) -> DataFrame:
    return value_counts(encounters, "discharge_disposition")


def enriched(encounters: DataFrame) -> DataFrame:
    """Encounters with the labels that exports carry."""
    return encounters.withColumns({
        "diagnosis_name": term.diagnosis_label(F.col("primary_diagnosis_code"), F.col("primary_diagnosis_chapter")),
        "procedure_name": term.procedure_label(F.col("primary_procedure_code")),
        "hospital_name": term.hospital_label(F.col("organization_id")),
    })


def volumes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    from functools import reduce

    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n") for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, counts)
