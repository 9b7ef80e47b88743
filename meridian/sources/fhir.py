"""Synthetic FHIR bundles from a seed, and bundles flattened to one row for each resource."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.tables import SYSTEM_CID10, SYSTEM_CNES, SYSTEM_CPF, SYSTEM_SIGTAP

FAMILIES = ("Silva", "Souza", "Lima", "Costa", "Rocha", "Alves")
GIVEN = ("Ana", "Bruno", "Carla", "Davi", "Elisa", "Fabio")
CITIES = ("120040", "120020", "120050", "120060")
CODES = ("A90", "I10", "E11.9", "J18.9", "R10")
DONE = ("0301010072", "0303010010", "0201010010")

ENTRY = "array<struct<resource:string>>"


def _choice(values: tuple[str, ...], *key: Column | str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64(*key), F.lit(len(values))) + 1).cast("int"))


def bundles(spark: SparkSession, patients: int, encounters: int, seed: int = 0) -> DataFrame:
    """bundle_id and entry: per patient 1 Patient, 1 Organization and ``encounters`` times Encounter, Condition,
    Observation and Procedure. The same seed gives the same bundles on any number of partitions."""
    s = F.lit(seed)
    df = spark.range(patients).withColumn("p", F.concat(F.lit("p"), F.col("id").cast("string")))
    birth = F.date_format(F.date_add(F.lit("1940-01-01").cast("date"), F.pmod(F.xxhash64("id", s), F.lit(25_000)).cast("int")), "yyyy-MM-dd")
    cpf = F.lpad(F.pmod(F.xxhash64("id", s, F.lit("cpf")), F.lit(10**11)).cast("string"), 11, "0")
    name = F.struct(_choice(FAMILIES, "id", s, F.lit("f")).alias("family"), F.array(_choice(GIVEN, "id", s, F.lit("g"))).alias("given"))
    ident = lambda system, value: F.array(F.struct(F.lit(system).alias("system"), value.alias("value")))
    city = F.array(F.struct(_choice(CITIES, "id", s, F.lit("c")).alias("city")))
    org = F.concat(F.lit("org"), F.col("id").cast("string"))
    json = lambda **parts: F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]))
    patient = json(resourceType=F.lit("Patient"), id=F.col("p"), name=F.array(name), birthDate=birth, gender=_choice(("male", "female"), "id", s, F.lit("x")), identifier=ident(SYSTEM_CPF, cpf), address=city)
    organization = json(resourceType=F.lit("Organization"), id=org, name=F.concat(F.lit("Hospital "), F.col("id").cast("string")), identifier=ident(SYSTEM_CNES, F.lpad(F.col("id").cast("string"), 7, "0")), address=city)
    ref = lambda kind, c: F.struct(F.concat(F.lit(f"{kind}/"), c).alias("reference"))
    coded = lambda system, code: F.struct(F.array(F.struct(F.lit(system).alias("system"), code.alias("code"), code.alias("display"))).alias("coding"))

    def visit(i: Column) -> Column:
        key = F.concat(F.col("p"), F.lit("-"), i.cast("string"))
        enc = F.concat(F.lit("e-"), key)
        start = F.date_add(F.lit("2025-01-01").cast("date"), F.pmod(F.xxhash64(key, s), F.lit(28)).cast("int"))
        day = lambda d: F.date_format(d, "yyyy-MM-dd")
        period = F.struct(day(start).alias("start"), day(F.date_add(start, 3)).alias("end"))
        subject = ref("Patient", F.col("p"))
        return F.array(
            json(resourceType=F.lit("Encounter"), id=enc, status=F.lit("finished"), **{"class": F.struct(F.lit("IMP").alias("code"))}, subject=subject, serviceProvider=ref("Organization", org), period=period),
            json(resourceType=F.lit("Condition"), id=F.concat(F.lit("c-"), key), subject=subject, encounter=ref("Encounter", enc), code=coded(SYSTEM_CID10, _choice(CODES, key, s)), recordedDate=day(start)),
            json(resourceType=F.lit("Observation"), id=F.concat(F.lit("o-"), key), status=F.lit("final"), subject=subject, encounter=ref("Encounter", enc)),
            json(resourceType=F.lit("Procedure"), id=F.concat(F.lit("r-"), key), status=F.lit("completed"), subject=subject, encounter=ref("Encounter", enc), code=coded(SYSTEM_SIGTAP, _choice(DONE, key, s)), performedDateTime=day(start)),
        )

    visits = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(encounters)), visit)) if encounters else F.array().cast("array<string>")
    return df.select(F.col("p").alias("bundle_id"), F.concat(F.array(patient, organization), visits).alias("entry"))


def flatten(found: DataFrame) -> DataFrame:
    """One row for each resource: type, id, raw_json, and the columns of patients and encounters, else null."""
    rows = found.select(F.explode("entry").alias("raw_json"))
    of = lambda path: F.get_json_object("raw_json", path)
    kind = of("$.resourceType")
    only = lambda wanted, c: F.when(kind == wanted, c)
    given = F.from_json(of("$.name[0].given"), "array<string>")
    ids = F.from_json(of("$.identifier"), "array<struct<system:string,value:string>>")
    cpf = F.try_element_at(F.filter(ids, lambda x: F.contains(F.lower(x["system"]), F.lit("cpf"))), F.lit(-1))["value"]
    return rows.select(
        kind.alias("resourceType"), of("$.id").alias("id"), "raw_json",
        only("Patient", of("$.name[0].family")).alias("name_family"), only("Patient", F.array_join(given, ", ")).alias("name_given"), only("Patient", of("$.birthDate")).alias("birthDate"),
        only("Patient", of("$.gender")).alias("gender"), only("Patient", cpf).alias("cpf"),
        only("Encounter", of("$.subject.reference")).alias("subject_ref"), only("Encounter", of("$.period.start")).alias("period_start"), only("Encounter", of("$.period.end")).alias("period_end"),
    )
