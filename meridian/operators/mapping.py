"""Mappers from source rows to the canonical tables, each a set of projections over one lazy frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import terminology as term
from meridian.functions.tables import SYSTEM_CID10, SYSTEM_SIGTAP
from meridian.functions.text import decimal_number, digits, filled, salted_hash, strip, whole_number, zero_pad
from meridian.operators.relational import ensure_columns, keep_first, pick

#: Where a row stands in its source; "keep first" goes by it.
ORDINAL = "_ordinal"


@dataclass(frozen=True)
class CanonicalDataset:
    dim_patients: DataFrame | None = None
    dim_organizations: DataFrame | None = None
    dim_health_plans: DataFrame | None = None
    fct_encounters: DataFrame | None = None
    fct_conditions: DataFrame | None = None
    fct_procedures: DataFrame | None = None
    fct_referrals: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame | None]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def summary(self) -> dict[str, int]:
        """Row counts; runs the plans."""
        return {k: v.count() if v is not None else 0 for k, v in self.tables().items()}


def with_ordinal(df: DataFrame) -> DataFrame:
    """Numbers rows as they stand in their files and splits; a column that is there already stays."""
    return df if ORDINAL in df.columns else df.withColumn(ORDINAL, F.monotonically_increasing_id())


def _first(df: DataFrame, key: str) -> DataFrame:
    return keep_first(df, [key], [ORDINAL]).drop(ORDINAL)


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def _facility(code: Column) -> Column:
    """Digits padded to seven on both sides of the join, so that it finds what it should."""
    return zero_pad(digits(filled(code)), 7)


def map_admissions(df: DataFrame, source_file: str | None = None) -> CanonicalDataset:
    df = with_ordinal(df)
    has = lambda *names: pick(df, *names)
    aih, birth, home = filled(has("N_AIH")), filled(has("NASC")), filled(has("MUNIC_RES"))
    blank = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    file = has("_source_file") if source_file is None else F.lit(source_file)
    linked = F.when(F.length(birth) >= 8, F.concat(F.lit("pat_hash_"), F.substring(F.sha2(F.concat(birth, F.lit("_"), F.coalesce(home, F.lit(""))), 256), 1, 16)))
    base = df.select(
        ORDINAL,
        F.concat(F.lit("enc_sih_"), F.coalesce(aih, F.substring(blank, 1, 12))).alias("encounter_id"),
        F.coalesce(F.concat(F.lit("pat_"), filled(has("CPF_AUT"))), linked, F.concat(F.lit("pat_sih_"), F.coalesce(aih, F.substring(blank, 1, 12)))).alias("patient_id"),
        F.coalesce(F.concat(F.lit("org_cnes_"), _facility(has("CNES", "MUNIC_MOV"))), F.lit("org_cnes_unknown")).alias("organization_id"),
        term.gender(has("SEXO")).alias("gender"),
        F.when(F.length(birth) == 64, birth).alias("birth_date_hash"),
        term.municipality(home).alias("place"),
        term.encounter_class(has("CAR_INT")).alias("encounter_class"),
        term.compact_date(has("DT_INTER")).alias("period_start"),
        term.compact_date(has("DT_SAIDA")).alias("period_end"),
        whole_number(has("DIAS_PERM")).alias("length_of_stay_days"),
        term.diagnosis(has("DIAG_PRINC")).alias("primary"),
        term.diagnosis(has("DIAG_SECUN", "DIAGSEC1")).alias("secondary"),
        term.procedure(has("PROC_REA")).alias("procedure"),
        F.coalesce(decimal_number(has("VAL_TOT")), F.lit(0.0)).alias("total_cost_brl"),
        F.when(F.lower(strip(has("MORTE"))).isin("1", "true"), "expired").otherwise("discharged_alive").alias("discharge_disposition"),
        file.alias("_source_file"),
        _now().alias("_updated_at"),
    )
    patients = base.select(ORDINAL, "patient_id", "gender", "birth_date_hash", F.col("place.code").alias("municipality_code"), F.col("place.state").alias("state"), F.lit("DATASUS_SIH").alias("_source_system"), "_updated_at")
    encounters = base.select(
        ORDINAL, "encounter_id", "patient_id", "organization_id", "encounter_class", F.lit("finished").alias("status"), "period_start", "period_end", "length_of_stay_days",
        F.col("primary.code").alias("primary_diagnosis_code"), F.col("primary.chapter").alias("primary_diagnosis_chapter"), F.col("procedure.code").alias("primary_procedure_code"),
        "total_cost_brl", "discharge_disposition", "_source_file", "_updated_at",
    )
    ranked = F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(s).alias("suffix"), F.col(r).alias("found")) for r, s in (("primary", "pri"), ("secondary", "sec"))])
    conditions = base.withColumn("c", F.explode(F.filter(ranked, lambda x: x["found"]["code"].isNotNull()))).select(
        ORDINAL, F.concat_ws("_", F.lit("cond"), "encounter_id", "c.suffix").alias("condition_id"), "encounter_id", "patient_id", F.lit(SYSTEM_CID10).alias("code_system"),
        F.col("c.found.code").alias("code"), F.col("c.found.valid").alias("valid"), F.col("c.found.chapter").alias("chapter"), F.col("c.found.chapter_description").alias("chapter_description"),
        F.col("c.rank").alias("diagnosis_rank"), F.col("period_start").alias("recorded_date"), "_updated_at",
    )
    procedures = base.filter("procedure.code is not null").select(
        ORDINAL, F.concat(F.lit("proc_"), "encounter_id", F.lit("_01")).alias("procedure_id"), "encounter_id", "patient_id", F.lit(SYSTEM_SIGTAP).alias("code_system"), F.col("procedure.code").alias("code"),
        F.col("procedure.formatted").alias("formatted_code"), F.col("procedure.group_description").alias("group_description"), F.lit("completed").alias("status"), F.col("period_start").alias("performed_date"), "_updated_at",
    )
    return CanonicalDataset(dim_patients=_first(patients, "patient_id"), fct_encounters=_first(encounters, "encounter_id"), fct_conditions=_first(conditions, "condition_id"), fct_procedures=_first(procedures, "procedure_id"))


def map_facilities(df: DataFrame, source_file: str | None = None) -> CanonicalDataset:
    df = with_ordinal(df)
    code = _facility(pick(df, "CNES"))
    place = term.municipality(F.coalesce(filled(pick(df, "CODUFMUN")), filled(pick(df, "MUNIC_RES"))))
    rows = df.filter(F.coalesce(code, F.lit("")) != "").select(
        ORDINAL,
        F.concat(F.lit("org_cnes_"), code).alias("organization_id"),
        code.alias("cnes_code"),
        F.coalesce(filled(pick(df, "NOME_FANTASIA")), filled(pick(df, "RAZAO_SOCIAL")), F.concat(F.lit("Estabelecimento CNES "), code)).alias("name"),
        F.coalesce(filled(pick(df, "TP_UNID")), filled(pick(df, "TIPO_UNIDADE")), F.lit("Hospital")).alias("facility_type"),
        place["code"].alias("municipality_code"),
        place["state"].alias("state"),
        whole_number(pick(df, "LEITOS", "QTLEITOS")).alias("bed_capacity"),
        (pick(df, "_source_file") if source_file is None else F.lit(source_file)).alias("_source_file"),
        _now().alias("_updated_at"),
    )
    return CanonicalDataset(dim_organizations=_first(rows, "organization_id"))


#: What is read of a resource; Patient and Organization differ in ``name``.
_REFERENCE = "struct<reference:string>"
_CODE = "struct<coding:array<struct<system:string,code:string,display:string>>>"
FHIR_SCHEMA = f"status string, identifier array<struct<system:string,value:string>>, address array<struct<city:string>>, subject {_REFERENCE}, encounter {_REFERENCE}, serviceProvider {_REFERENCE}, period struct<start:string,end:string>, class struct<code:string>, code {_CODE}, recordedDate string, performedDateTime string"


def _id_after(c: Column, kind: str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.coalesce(filled(F.regexp_replace(c, f"^{kind}/", "")), F.lit("unknown")))


def map_fhir(df: DataFrame, source_file: str | None = None) -> CanonicalDataset:
    """One parse of raw_json feeds all tables. It must be the resource itself, not its hash: take the structure before
    the privacy gate hashes the column."""
    df = with_ordinal(ensure_columns(df, {c: "string" for c in ("raw_json", "gender", "birthDate", "name_family", "period_start", "period_end", "subject_ref", "_source_file")}))
    doc = F.from_json("raw_json", FHIR_SCHEMA, {"allowSingleQuotes": "true"})
    rows = df.withColumn("r", doc).withColumn("org_name", F.get_json_object("raw_json", "$.name")).withColumn("_updated_at", _now())
    file = F.col("_source_file") if source_file is None else F.lit(source_file)
    first_code = F.try_element_at(F.col("r.code.coding"), F.lit(1))["code"]
    today = F.date_format(F.current_date(), "yyyy-MM-dd")
    of = lambda kind: rows.filter(F.col("resourceType") == kind)
    birth = filled(F.col("birthDate"))
    city = term.municipality(F.try_element_at(F.col("r.address"), F.lit(1))["city"])
    patients = of("Patient").select(
        ORDINAL, F.concat(F.lit("pat_fhir_"), "id").alias("patient_id"), F.coalesce(F.lower(filled(F.col("gender"))), F.lit("unknown")).alias("gender"), F.when(F.length(birth) == 64, birth).alias("birth_date_hash"),
        city["code"].alias("municipality_code"), city["state"].alias("state"), F.lit("FHIR_R4").alias("_source_system"), "_updated_at",
    )
    own = F.try_element_at(F.filter("r.identifier", lambda x: F.contains(F.lower(x["system"]), F.lit("cnes"))), F.lit(-1))["value"]
    organizations = of("Organization").select(
        ORDINAL, F.concat(F.lit("org_fhir_"), "id").alias("organization_id"), F.coalesce(own, F.substring("id", 1, 7)).alias("cnes_code"), F.coalesce(filled(F.col("org_name")), F.concat(F.lit("Organization "), "id")).alias("name"),
        F.lit("Hospital Geral").alias("facility_type"), city["code"].alias("municipality_code"), city["state"].alias("state"), F.lit(50).alias("bed_capacity"), file.alias("_source_file"), "_updated_at",
    )
    day = lambda *cs: F.coalesce(*[F.when(F.length(c) >= 10, F.substring(c, 1, 10)) for c in cs])
    subject = F.coalesce(F.col("r.subject.reference"), F.col("subject_ref"))
    encounters = of("Encounter").select(
        ORDINAL, F.concat(F.lit("enc_fhir_"), "id").alias("encounter_id"), _id_after(subject, "Patient", "pat_fhir_").alias("patient_id"), _id_after(F.col("r.serviceProvider.reference"), "Organization", "org_fhir_").alias("organization_id"),
        F.coalesce(F.col("r.class.code"), F.lit("IMP")).alias("encounter_class"), F.coalesce(F.col("r.status"), F.lit("finished")).alias("status"), day(F.col("r.period.start"), F.col("period_start")).alias("period_start"), day(F.col("r.period.end"), F.col("period_end")).alias("period_end"),
        F.lit(3).alias("length_of_stay_days"), F.lit(None).cast("string").alias("primary_diagnosis_code"), F.lit(None).cast("string").alias("primary_diagnosis_chapter"), F.lit(None).cast("string").alias("primary_procedure_code"),
        F.lit(1500.0).alias("total_cost_brl"), F.lit("discharged_alive").alias("discharge_disposition"), file.alias("_source_file"), "_updated_at",
    )
    links = (_id_after(F.col("r.encounter.reference"), "Encounter", "enc_fhir_").alias("encounter_id"), _id_after(subject, "Patient", "pat_fhir_").alias("patient_id"))
    found = term.diagnosis(F.coalesce(first_code, F.lit("R10")))
    conditions = of("Condition").select(
        ORDINAL, F.concat(F.lit("cond_fhir_"), "id").alias("condition_id"), *links, F.lit(SYSTEM_CID10).alias("code_system"), found["code"].alias("code"), found["valid"].alias("valid"), found["chapter"].alias("chapter"),
        found["chapter_description"].alias("chapter_description"), F.lit("primary").alias("diagnosis_rank"), F.coalesce(day(F.col("r.recordedDate")), today).alias("recorded_date"), "_updated_at",
    )
    done = term.procedure(F.coalesce(first_code, F.lit("0301010010")))
    procedures = of("Procedure").select(
        ORDINAL, F.concat(F.lit("proc_fhir_"), "id").alias("procedure_id"), *links, F.lit(SYSTEM_SIGTAP).alias("code_system"), done["code"].alias("code"), done["formatted"].alias("formatted_code"),
        done["group_description"].alias("group_description"), F.lit("completed").alias("status"), F.coalesce(day(F.col("r.performedDateTime")), today).alias("performed_date"), "_updated_at",
    )
    return CanonicalDataset(
        dim_patients=_first(patients, "patient_id"), dim_organizations=_first(organizations, "organization_id"), fct_encounters=_first(encounters, "encounter_id"),
        fct_conditions=_first(conditions, "condition_id"), fct_procedures=_first(procedures, "procedure_id"),
    )


def map_referrals(df: DataFrame, salt: str, source_file: str | None = None) -> CanonicalDataset:
    """Waiting requests have a wait of 0 days and is_authorized false; authorized_at stays null."""
    from meridian.operators.identity import master_patient_id

    columns = ("ID_SOLICITACAO", "CNS_PACIENTE", "CPF_PACIENTE", "DT_NASC", "SEXO", "CO_MUNICIPIO_IBGE", "DT_SOLICITACAO", "DT_AUTORIZACAO", "TIPO_VAGA", "PROCEDIMENTO_SOLICITADO", "COD_ESTAB_SOLICITANTE", "COD_ESTAB_EXECUTANTE", "STATUS_REGULACAO", "GRAU_PRIORIDADE")
    df = with_ordinal(ensure_columns(df, {c: "string" for c in columns}))
    birth = filled(F.col("DT_NASC"))
    hashed = F.when(F.length(birth) == 64, birth).otherwise(salted_hash(birth, salt))
    patient = F.coalesce(filled(F.col("CNS_PACIENTE")), filled(F.col("CPF_PACIENTE")), F.col("ID_SOLICITACAO"))
    place = strip(F.col("CO_MUNICIPIO_IBGE"))
    rows = df.withColumns({"birth_date_hash": hashed, "municipality_code": place}).withColumn("patient_master_id", master_patient_id(patient, F.col("birth_date_hash"), F.col("municipality_code"), salt))
    sex = F.upper(strip(F.col("SEXO")))
    patients = rows.select(
        ORDINAL, F.col("patient_master_id").alias("patient_id"), "patient_master_id", F.when(sex == "M", "male").when(sex == "F", "female").otherwise("unknown").alias("gender"), "birth_date_hash", "municipality_code",
        term.municipality_label(place).alias("municipality_name"), F.coalesce(term.municipality(place)["state"], F.lit("AC")).alias("state"), F.lit("AC").alias("uf"), F.lit("sisreg_regulation").alias("source_type"), F.lit("SISREG").alias("_source_system"), _now().alias("_updated_at"),
    )
    org = lambda c: F.concat(F.lit("org_cnes_"), strip(F.col(c)))
    referrals = rows.select(
        F.concat(F.lit("ref_"), F.col("ID_SOLICITACAO").cast("string")).alias("referral_id"), "patient_master_id",
        org("COD_ESTAB_SOLICITANTE").alias("request_organization_id"), term.hospital_label(F.col("COD_ESTAB_SOLICITANTE")).alias("request_hospital_name"),
        org("COD_ESTAB_EXECUTANTE").alias("executing_organization_id"), term.hospital_label(F.col("COD_ESTAB_EXECUTANTE")).alias("executing_hospital_name"),
        "municipality_code", term.municipality_label(place).alias("municipality_name"), F.col("TIPO_VAGA").alias("referral_type"),
        F.col("PROCEDIMENTO_SOLICITADO").alias("requested_procedure_code"), term.procedure_label(F.col("PROCEDIMENTO_SOLICITADO")).alias("requested_procedure_name"),
        F.col("GRAU_PRIORIDADE").alias("priority_level"), F.col("STATUS_REGULACAO").alias("status"), F.col("DT_SOLICITACAO").cast("string").alias("requested_at"), F.col("DT_AUTORIZACAO").cast("string").alias("authorized_at"),
        term.days_between(F.col("DT_AUTORIZACAO"), F.col("DT_SOLICITACAO")).alias("wait_time_days"), F.col("DT_AUTORIZACAO").isNotNull().alias("is_authorized"),
    )
    return CanonicalDataset(dim_patients=_first(patients, "patient_master_id"), fct_referrals=referrals)


def map_health_plans(df: DataFrame, source_file: str | None = None) -> CanonicalDataset:
    place = strip(F.col("CD_MUNICIPIO_IBGE"))
    text = lambda c: pick(df, c)
    plans = df.select(
        F.concat_ws("_", F.lit("ans_plan"), strip(F.col("CD_OPERADORA")), place).alias("plan_id"), strip(F.col("CD_OPERADORA")).alias("ans_operator_code"), text("RAZAO_SOCIAL").alias("operator_name"), text("MODALIDADE_OPERADORA").alias("modality"),
        place.alias("municipality_code"), term.municipality_label(place).alias("municipality_name"), text("SG_UF").alias("state"), text("COMPETENCIA").alias("competence"),
        whole_number(text("NR_BENEFICIARIOS_ATIVOS")).alias("active_beneficiaries"), whole_number(text("NR_BENEFICIARIOS_IDOSOS")).alias("elderly_beneficiaries"),
        decimal_number(text("DESPESA_ASSISTENCIAL_TOTAL")).alias("total_private_expenditure_brl"), decimal_number(text("SINISTRALIDADE_PCT")).alias("loss_ratio_pct"),
        term.coverage_ratio(whole_number(text("NR_BENEFICIARIOS_ATIVOS")), place).alias("private_coverage_ratio_pct"),
    )
    return CanonicalDataset(dim_health_plans=plans)


def mapper_for(source_type: str, salt: str) -> Callable[[DataFrame], CanonicalDataset]:
    """By source type; anything with fhir in its name is FHIR."""
    name = source_type.lower()
    known: dict[str, Callable] = {"sih": map_admissions, "cnes": map_facilities, "ans": map_health_plans, "ans_data": map_health_plans, "sisreg": lambda df: map_referrals(df, salt), "sisreg_regulation": lambda df: map_referrals(df, salt)}
    short = name.removeprefix("datasus_")
    if short in known:
        return known[short]
    if "fhir" in name:
        return map_fhir
    raise ValueError(f"no mapper for {source_type}")
