from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from meridian.operators import identity, mapping, privacy
from meridian.operators.relational import ensure_columns, keep_first, value_counts
from meridian.operators.validation import validate
from meridian.plans import analytics
from meridian.plans.jobs import SilverPipeline
from meridian.sources import readers


def test_personal_columns():
    assert privacy.personal_columns("datasus_sih", ["X", "CPF_AUT", "N_AIH"]) == ["N_AIH", "CPF_AUT"]
    assert privacy.personal_columns("unknown", ["CPF_AUT"]) == []


def test_anonymize(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b")], "CPF string, x string")
    out, audit = privacy.anonymize(df, ["CPF", "gone"], "s")
    rows = out.collect()
    assert len(rows[0].CPF) == 64 and rows[1].CPF is None and rows[0].x == "a"
    assert audit == {"status": "success", "anonymized_columns": ["CPF"]}
    assert privacy.anonymize(df, [], "s")[1]["status"] == "no_pii_fields_provided"
    assert privacy.anonymize(df, ["CPF"], "t")[0].first().CPF != rows[0].CPF
    with pytest.raises(ValueError):
        privacy.anonymize({"a": 1}, ["a"], "s")


def test_salt_fails_closed(monkeypatch):
    monkeypatch.delenv("SALT_SECRET", raising=False)
    with pytest.raises(privacy.MissingSalt):
        privacy.resolve_salt()
    assert privacy.resolve_salt(insecure_default="x") == "x"
    monkeypatch.setenv("SALT_SECRET", "env")
    assert privacy.resolve_salt() == "env" and privacy.resolve_salt("own") == "own"


def test_manifest(tmp_path):
    assert privacy.load_manifest(str(tmp_path / "none.yaml")) == {}
    (tmp_path / "m.yaml").write_text("a:\n  - x\n")
    assert privacy.load_manifest(str(tmp_path / "m.yaml")) == {"a": ["x"]}


def test_validation(spark):
    df = spark.createDataFrame([("1",)], "N_AIH string")
    r = validate(df, "datasus_sih")
    assert r.counts() == {"reason": "Missing columns: ['ANO_CMPT', 'MES_CMPT', 'PROC_REA']", "total": 1, "valid": 0, "rejected": 1}
    assert validate(spark.createDataFrame([("1",)], "AP_PRID string"), "datasus_sia").counts()["valid"] == 1
    assert validate(df, "datasus_sia").stats["reason"] == "Missing columns: ['PA_PROC_ID']"
    fhir = spark.createDataFrame([("Patient", "1"), ("Foo", "2"), (None, "3")], "resourceType string, id string")
    r = validate(fhir, "fhir_synthetic")
    assert (r.valid.count(), r.rejected.count()) == (1, 2)
    assert validate(df, "whatever").counts()["valid"] == 1
    empty = readers.sample_referrals(spark).limit(0)
    assert validate(empty, "sisreg_regulation").counts() == {"reason": "DataFrame vazio", "total": 0, "valid": 0, "rejected": 0}


def test_keep_first_and_counts(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 1)], "k string, o int")
    assert sorted((r.k or "", r.o) for r in keep_first(df, ["k"], ["o"]).collect()) == [("", 1), ("a", 1), ("b", 5)]
    assert [(r.k, r.n) for r in value_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert ensure_columns(df, {"z": "string", "k": "string"}).columns == ["k", "o", "z"]


ADMISSIONS = "N_AIH string, NASC string, SEXO string, MUNIC_RES string, CPF_AUT string, CNES string, DT_INTER string, DT_SAIDA string, DIAS_PERM string, VAL_TOT string, MORTE string, CAR_INT string, DIAG_PRINC string, DIAG_SECUN string, PROC_REA string"


def admissions(spark):
    return spark.createDataFrame(
        [
            ("1", "a" * 64, "1", "120040", None, "2001578", "20250101", "20250105", "4", "1.234,5", "0", "02", "A90", "0000", "0303010010"),
            ("2", "a" * 64, "3", "120040", None, "5336171", "20250110", "20250130", "20", "2000,50", "1", "1", "i219", None, "303060034"),
            ("3", "19800101", None, None, "cpf", "7", None, None, "x", None, None, None, None, "E119", None),
        ],
        ADMISSIONS,
    ).coalesce(1)


def test_admissions(spark):
    ds = mapping.map_admissions(admissions(spark), "f")
    e = {r.encounter_id: r for r in ds.fct_encounters.collect()}
    assert e["enc_sih_1"].total_cost_brl == 0.0  # two separators are no number
    assert (e["enc_sih_2"].total_cost_brl, e["enc_sih_2"].discharge_disposition, e["enc_sih_2"].encounter_class) == (2000.5, "expired", "AMB")
    assert (e["enc_sih_3"].length_of_stay_days, e["enc_sih_3"].organization_id, e["enc_sih_3"].period_start) == (None, "org_cnes_0000007", None)
    assert e["enc_sih_2"].primary_diagnosis_code == "I21.9" and e["enc_sih_2"].primary_procedure_code == "0303060034"
    c = {r.condition_id: r for r in ds.fct_conditions.collect()}
    assert set(c) == {"cond_enc_sih_1_pri", "cond_enc_sih_1_sec", "cond_enc_sih_2_pri", "cond_enc_sih_3_sec"}
    assert c["cond_enc_sih_1_sec"].valid is False and c["cond_enc_sih_1_sec"].chapter is None
    assert {r.procedure_id for r in ds.fct_procedures.collect()} == {"proc_enc_sih_1_01", "proc_enc_sih_2_01"}
    p = {r.patient_id: r for r in ds.dim_patients.collect()}
    assert {r._source_system for r in p.values()} == {"DATASUS_SIH"}
    assert len(p) == 2 and p["pat_cpf"].gender == "unknown" and p["pat_cpf"].birth_date_hash is None


def test_identity(spark):
    ds = identity.resolve(mapping.map_admissions(admissions(spark), "f"), "salt")
    ids = {r.patient_id: r.patient_master_id for r in ds.dim_patients.collect()}
    facts = {r.patient_id: r.patient_master_id for r in ds.fct_encounters.collect()}
    assert ids == facts and all(v.startswith("mpi_") and len(v) == 20 for v in ids.values())
    lone = spark.createDataFrame([("p", "b" * 64, None)], "patient_id string, b string, m string")
    key = lambda **k: lone.select(identity.master_patient_id(F.col("patient_id"), F.col("b"), F.col("m"), "s", **k).alias("k")).first().k
    assert key() != key(null_as_text=True)


def test_facilities(spark):
    df = spark.createDataFrame([("2001578", "120040", " HC ", "05", "100"), ("12", "120040", None, None, "x"), (" ", "1", "n", None, None)], "CNES string, CODUFMUN string, NOME_FANTASIA string, TP_UNID string, LEITOS string")
    rows = {r.cnes_code: r for r in mapping.map_facilities(df, "f").dim_organizations.collect()}
    assert set(rows) == {"2001578", "0000012"}
    assert (rows["2001578"].name, rows["2001578"].bed_capacity) == ("HC", 100)
    assert (rows["0000012"].name, rows["0000012"].facility_type, rows["0000012"].bed_capacity) == ("Estabelecimento CNES 0000012", "Hospital", None)


def test_fhir(spark):
    raw = lambda **x: json.dumps(x)
    rows = [
        ("Patient", "p1", "female", "1980-05-10", raw(address=[{"city": "1200401"}])),
        ("Organization", "org1", None, None, raw(name="Hospital X", identifier=[{"system": "other", "value": "9"}, {"system": "http://cnes.saude.gov.br", "value": "2001578"}])),
        ("Encounter", "e1", None, None, raw(status="finished", subject={"reference": "Patient/p1"}, serviceProvider={"reference": "Organization/org1"}, period={"start": "2025-01-02T10:00:00Z"}, **{"class": {"code": "AMB"}})),
        ("Condition", "c1", None, None, raw(subject={"reference": "Patient/p1"}, encounter={"reference": "Encounter/e1"}, code={"coding": [{"code": "A90"}]}, recordedDate="2025-01-02")),
        ("Procedure", "r1", None, None, "{'subject': {'reference': 'Patient/p1'}}"),
        ("Condition", "c2", None, None, "broken"),
    ]
    ds = mapping.map_fhir(spark.createDataFrame(rows, "resourceType string, id string, gender string, birthDate string, raw_json string"), "f")
    assert ds.dim_patients.first().patient_id == "pat_fhir_p1" and ds.dim_patients.first().municipality_code == "120040"
    assert ds.dim_patients.first()._source_system == "FHIR_R4"
    assert ds.dim_organizations.first().cnes_code == "2001578"
    e = ds.fct_encounters.first()
    assert (e.patient_id, e.organization_id, e.period_start, e.period_end, e.encounter_class) == ("pat_fhir_p1", "org_fhir_org1", "2025-01-02", None, "AMB")
    c = {r.condition_id: r for r in ds.fct_conditions.collect()}
    assert c["cond_fhir_c1"].code == "A90" and c["cond_fhir_c2"].code == "R10"
    assert ds.fct_procedures.first().formatted_code == "03.01.01.001-0"


def test_referrals_and_plans(spark):
    ds, _ = SilverPipeline(spark, "salt").transform_dataframe(readers.sample_referrals(spark), "sisreg_regulation")
    r = {x.referral_id: x for x in ds.fct_referrals.collect()}
    assert r["ref_SOL-2025-00101"].wait_time_days == 2.24 and r["ref_SOL-2025-00101"].request_hospital_name == "Hospital Regional do Juruá (Cruzeiro do Sul)"
    assert (r["ref_SOL-2025-00104"].wait_time_days, r["ref_SOL-2025-00104"].is_authorized, r["ref_SOL-2025-00104"].authorized_at) == (0.0, False, None)
    assert {x.patient_master_id for x in ds.dim_patients.collect()} == {x.patient_master_id for x in r.values()}
    assert {x.source_type for x in ds.dim_patients.collect()} == {"sisreg_regulation"}
    both = spark.createDataFrame([("1", "cns", "cpf")], "ID_SOLICITACAO string, CNS_PACIENTE string, CPF_PACIENTE string")
    of = lambda x: "mpi_" + hashlib.sha256(f"{x}_salt".encode()).hexdigest()[:16]
    assert mapping.map_referrals(both, "salt").fct_referrals.first().patient_master_id == of("cns")
    assert mapping.map_referrals(both.drop("CNS_PACIENTE"), "salt").fct_referrals.first().patient_master_id == of("cpf")
    plans, _ = SilverPipeline(spark, "salt").transform_dataframe(readers.sample_plans(spark), "ans_data")
    p = {x.plan_id: x for x in plans.dim_health_plans.collect()}
    assert p["ans_plan_345678_120040"].private_coverage_ratio_pct == 11.56 and len(p) == 5
    with pytest.raises(ValueError):
        mapping.mapper_for("datasus_sia", "s")


def test_reports(spark):
    ds = identity.resolve(mapping.map_admissions(admissions(spark), "f"), "salt")
    e, p = ds.fct_encounters.cache(), ds.dim_patients.cache()
    k = analytics.global_kpis(e).first()
    assert (k.admissions, k.deaths, round(k.mortality_pct, 2)) == (3, 1, 33.33)
    assert analytics.readmissions(e).first().readmitted == 1
    assert [r.step for r in analytics.super_user(e).collect()] == [1, 2]
    assert analytics.multi_hospital(e).first().hospitals == 2
    assert analytics.expired_journeys(e).count() == 1
    assert analytics.alive_then_expired(e).count() == 1
    assert analytics.journey_details(e, ds.fct_conditions, ds.fct_procedures).count() == 3
    assert analytics.long_stays(e).first().long_stays == 1
    assert analytics.lethal_diagnoses(e, least=1).first().primary_diagnosis_code == "I21.9"
    orgs = mapping.map_facilities(spark.createDataFrame([("2001578", "120040", "10")], "CNES string, CODUFMUN string, LEITOS string"), "f").dim_organizations
    o = analytics.occupancy(e, orgs).first()
    assert (o.days, o.beds) == (4, 10)
    moved = analytics.migration(e, p, orgs)
    assert analytics.migration_rate(moved).first().travelled == 2
    assert analytics.migration_matrix(moved, ["120040"]).count() == 0  # one hospital's place is known, and that is home
    genders, places = analytics.demography(e, p)
    assert {r.gender for r in genders.collect()} == {"male", "unknown"} and places.first().municipality == "Rio Branco (Capital)"
    assert analytics.birth_modes(e).first().cesarean_pct == 0.0
    assert analytics.enriched(e).filter("diagnosis_name = 'Dengue Clássica'").count() == 1
    bands = analytics.age_bands(e.withColumn("IDADE", F.lit("19"))).first()
    assert (bands.band, bands.n) == ("(12, 19]", 3)
    pyramid = analytics.care_pyramid(readers.sample_primary_care(spark), spark.createDataFrame([("0201010010", "2", "10.0")], "PA_PROC_ID string, PA_QTDPRO string, PA_VALPRO string"), e).first()
    assert pyramid.primary_visits == 1420.0 and pyramid.admissions == 3
