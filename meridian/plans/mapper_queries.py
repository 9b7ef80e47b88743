"""Registered queries of the mappers: the star-schema tables in the columns of each source, and the SQL of what comes out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import tables, terminology
from meridian.operators import mapping
from meridian.plans.registry import nth, query, quoted, sql_case, sql_nth

SALT = "bench-salt"
#: Stamps of the time and of the run, which no SQL can know.
STAMPS = ("_updated_at", "_source_file")
_STATES = sql_case("substr({}, 1, 2)", tables.STATES)
_CHAPTER = "CASE " + " ".join(f"WHEN {{0}} BETWEEN '{a}' AND '{b}' THEN {quoted(name)}" for name, (a, b, _) in tables.CHAPTERS.items()) + " ELSE 'UNKNOWN' END"
_CHAPTER_TEXT = "CASE " + " ".join(f"WHEN {{0}} BETWEEN '{a}' AND '{b}' THEN {quoted(text)}" for a, b, text in tables.CHAPTERS.values()) + f" ELSE {quoted(tables.NO_CHAPTER)} END"
_SEXES, _CLASSES, _SECOND = ["1", "3", " m ", "F", None], ["02", "1", "3", " 01 ", None, "9"], ["e119", "I10", "0000", "O80.0", "X"]


def _text(c: Column) -> Column:
    return c.cast("string")


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*STAMPS)


def _diagnosis_sql(raw: str) -> str:
    """code, valid, chapter and chapter text of an upper-case code, as fields of a struct; null for none."""
    c = f"substr(regexp_replace({raw}, '[^A-Z0-9]', '', 'g'), 1, 3)"
    rest = f"substr(regexp_replace({raw}, '[^A-Z0-9]', '', 'g'), 4)"
    valid = f"regexp_full_match({c}, '[A-Z][0-9]{{2}}')"
    return f"""CASE WHEN {raw} IS NOT NULL THEN {{'code': CASE WHEN NOT {valid} THEN {raw} WHEN {rest} = '' THEN {c} ELSE {c} || '.' || {rest} END, 'valid': {valid},
 'chapter': CASE WHEN {valid} THEN {_CHAPTER.format(c)} END, 'text': CASE WHEN {valid} THEN {_CHAPTER_TEXT.format(c)} END}} END"""


def _admissions(orders: DataFrame) -> DataFrame:
    """Orders as hospital admissions; what a patient is follows from the customer."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    two = F.lpad(_text(k % 100), 2, "0")
    first = F.concat(F.char((k % 26 + 97).cast("int")), two, F.when(k % 3 == 0, F.concat(F.lit("."), _text(k % 10))).otherwise(""))
    return orders.select(
        _text(k).alias("N_AIH"), F.when(c % 4 == 1, F.concat(F.lit("1980"), F.lpad(_text(c), 6, "0"))).when(c % 4 > 1, F.sha2(_text(c), 256)).alias("NASC"), nth(_SEXES, c).alias("SEXO"),
        F.when(c % 7 != 0, F.concat(F.lit("1200"), F.lpad(_text(c % 90), 2, "0"))).alias("MUNIC_RES"), F.when(c % 6 == 0, F.concat(F.lit("cpf"), _text(c))).alias("CPF_AUT"), _text(k % 500).alias("CNES"),
        F.when(k % 9 == 0, "00000000").otherwise(day).alias("DT_INTER"), F.when(k % 5 != 0, F.concat(day, F.lit(".0"))).alias("DT_SAIDA"), F.when(k % 8 == 0, "x").otherwise(F.concat(_text(k % 30), F.lit(".0"))).alias("DIAS_PERM"),
        F.when(k % 10 != 0, F.concat(_text(k * 7 % 100000), F.lit(","), two)).alias("VAL_TOT"), F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "P", "True").otherwise("0").alias("MORTE"), nth(_CLASSES, k).alias("CAR_INT"),
        F.when(k % 13 == 0, "0000").otherwise(first).alias("DIAG_PRINC"), F.when(k % 2 == 0, nth(_SECOND, k)).alias("DIAG_SECUN"), F.when(k % 4 != 0, F.concat(F.lit("0"), _text(k % 9 + 1), F.lpad(_text(k), 8, "0"))).alias("PROC_REA"),
    )


_FIRST = "CASE WHEN o_orderkey % 13 = 0 THEN '0000' ELSE chr(CAST(65 + o_orderkey % 26 AS INT)) || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || CASE WHEN o_orderkey % 3 = 0 THEN '.' || (o_orderkey % 10) ELSE '' END END"
_A = f"""(SELECT *, 'enc_sih_' || o_orderkey AS encounter_id, CASE WHEN o_custkey % 6 = 0 THEN 'pat_cpf' || o_custkey WHEN birth IS NOT NULL THEN 'pat_hash_' || substr(sha256(birth || '_' || coalesce(home, '')), 1, 16) ELSE 'pat_sih_' || o_orderkey END AS patient_id,
 CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS began, {_diagnosis_sql(_FIRST)} AS one, {_diagnosis_sql(f"CASE WHEN o_orderkey % 2 = 0 THEN upper({sql_nth(_SECOND, 'o_orderkey')}) END")} AS two,
 CASE WHEN o_orderkey % 4 <> 0 THEN '0' || (o_orderkey % 9 + 1) || lpad(o_orderkey::VARCHAR, 8, '0') END AS proc FROM
 (SELECT *, CASE WHEN o_custkey % 4 = 1 THEN '1980' || lpad(o_custkey::VARCHAR, 6, '0') WHEN o_custkey % 4 > 1 THEN sha256(o_custkey::VARCHAR) END AS birth, CASE WHEN o_custkey % 7 <> 0 THEN '1200' || lpad((o_custkey % 90)::VARCHAR, 2, '0') END AS home FROM orders))"""


@query(f"""SELECT DISTINCT patient_id, CASE upper(trim({sql_nth(_SEXES, "o_custkey")})) WHEN '1' THEN 'male' WHEN 'M' THEN 'male' WHEN '3' THEN 'female' WHEN 'F' THEN 'female' ELSE 'unknown' END AS gender,
 CASE WHEN length(birth) = 64 THEN birth END AS birth_date_hash, home AS municipality_code, CASE WHEN home IS NOT NULL THEN coalesce({_STATES.format("home")}, 'BR') END AS state, 'DATASUS_SIH' AS _source_system FROM {_A}""")
def admission_patients(orders):
    return _plain(mapping.map_admissions(_admissions(orders)).dim_patients)


@query(f"""SELECT encounter_id, patient_id, 'org_cnes_' || lpad((o_orderkey % 500)::VARCHAR, 7, '0') AS organization_id,
 CASE {sql_nth([(x or "").strip() for x in _CLASSES], "o_orderkey")} WHEN '02' THEN 'EMER' WHEN '3' THEN 'EMER' WHEN '1' THEN 'AMB' WHEN '01' THEN 'AMB' ELSE 'IMP' END AS encounter_class, 'finished' AS status, began AS period_start,
 CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS period_end, CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderkey % 30 AS INTEGER) END AS length_of_stay_days, one.code AS primary_diagnosis_code, one.chapter AS primary_diagnosis_chapter,
 proc AS primary_procedure_code, CASE WHEN o_orderkey % 10 <> 0 THEN CAST((o_orderkey * 7 % 100000) || '.' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') AS DOUBLE) ELSE 0.0::DOUBLE END AS total_cost_brl,
 CASE WHEN o_orderstatus IN ('F', 'P') THEN 'expired' ELSE 'discharged_alive' END AS discharge_disposition FROM {_A}""")
def admission_encounters(orders):
    return _plain(mapping.map_admissions(_admissions(orders)).fct_encounters)


@query(f"""SELECT 'cond_' || encounter_id || suffix AS condition_id, encounter_id, patient_id, '{tables.SYSTEM_CID10}' AS code_system, d.code AS code, d.valid AS valid, d.chapter AS chapter, d.text AS chapter_description, diagnosis_rank, began AS recorded_date FROM
 (SELECT encounter_id, patient_id, began, one AS d, '_pri' AS suffix, 'primary' AS diagnosis_rank FROM {_A} UNION ALL SELECT encounter_id, patient_id, began, two, '_sec', 'secondary' FROM {_A}) WHERE d IS NOT NULL""")
def explode_secondary(orders):
    """The primary and the secondary diagnosis of an admission as conditions."""
    return _plain(mapping.map_admissions(_admissions(orders)).fct_conditions)


_SHAPED = "substr({0},1,2)||'.'||substr({0},3,2)||'.'||substr({0},5,2)||'.'||substr({0},7,3)||'-'||substr({0},10,1)"
_GROUP = "coalesce(" + sql_case("substr({0}, 1, 2)", tables.PROCEDURE_GROUPS) + f", {quoted(tables.NO_GROUP)})"


@query(f"""SELECT 'proc_' || encounter_id || '_01' AS procedure_id, encounter_id, patient_id, '{tables.SYSTEM_SIGTAP}' AS code_system, proc AS code, {_SHAPED.format("proc")} AS formatted_code, {_GROUP.format("proc")} AS group_description,
 'completed' AS status, began AS performed_date FROM {_A} WHERE proc IS NOT NULL""")
def admission_procedures(orders):
    return _plain(mapping.map_admissions(_admissions(orders)).fct_procedures)


@query(f"""SELECT 'org_cnes_' || code AS organization_id, code AS cnes_code, coalesce(name, 'Estabelecimento CNES ' || code) AS name, coalesce(kind, 'Hospital') AS facility_type, place AS municipality_code, CASE WHEN place IS NOT NULL THEN coalesce({_STATES.format("place")}, 'BR') END AS state, beds AS bed_capacity
 FROM (SELECT lpad(s_suppkey::VARCHAR, 7, '0') AS code, CASE WHEN s_suppkey % 3 <> 0 THEN trim(s_name) END AS name, CASE WHEN s_suppkey % 4 = 0 THEN '05' END AS kind, CASE WHEN s_nationkey <> 7 THEN (120000 + s_nationkey)::VARCHAR END AS place,
 CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 200 AS INTEGER) END AS beds FROM supplier)""")
def facilities(supplier):
    k = F.col("s_suppkey")
    rows = supplier.select(
        _text(k).alias("CNES"), F.when(k % 3 != 0, F.concat(F.lit(" "), "s_name")).otherwise(" ").alias("NOME_FANTASIA"), F.when(k % 4 == 0, "05").alias("TP_UNID"),
        F.when(F.col("s_nationkey") != 7, F.concat(_text(F.col("s_nationkey") + 120000), F.lit("9"))).alias("CODUFMUN"), F.when(k % 5 != 0, _text(k % 200)).otherwise("many").alias("LEITOS"),
    )
    return _plain(mapping.map_facilities(rows).dim_organizations)


def _resources(customer: DataFrame, supplier: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, suppliers and orders as resources of five kinds, with their JSON."""
    nothing = F.lit(None).cast("string")

    def rows(df, kind, key, body, gender=nothing, birth=nothing):
        return df.select(F.lit(kind).alias("resourceType"), _text(key).alias("id"), gender.alias("gender"), birth.alias("birthDate"), body.alias("raw_json"))

    c, s, k = F.col("c_custkey"), F.col("s_suppkey"), F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    person = F.concat(F.lit('{"address":[{"city":"12004'), _text(c % 10), F.lit('"}]}'))
    place = F.format_string('{"name":"%s","identifier":[{"system":"http://other","value":"9"},{"system":"http://CNES.gov","value":"%s"}]}', F.when(s % 5 != 0, F.col("s_name")).otherwise(""), F.lpad(_text(s), 7, "0"))
    links = F.format_string('"subject":{"reference":"Patient/%s"},"encounter":{"reference":"Encounter/%s"}', _text(F.col("o_custkey")), _text(k))
    stay = F.format_string('{"status":"%s","subject":{"reference":"Patient/%s"},"serviceProvider":{"reference":"Organization/%s"},"period":{"start":"%sT10:00:00Z"%s},"class":{"code":"%s"}}',
        F.when(F.col("o_orderstatus") == "P", "in-progress").otherwise("finished"), _text(F.col("o_custkey")), _text(k % 30), day, F.when(k % 3 == 0, F.concat(F.lit(',"end":"'), day, F.lit('T11:00:00Z"'))).otherwise(""), F.when(k % 2 == 0, "AMB").otherwise("EMER"))
    coded = lambda date, code: F.concat(F.lit("{"), links, F.format_string(',"%s":"%s"', F.lit(date), day), F.when(k % 4 != 0, F.concat(F.lit(',"code":{"coding":[{"system":"x","code":"'), code, F.lit('"}]}'))).otherwise(""), F.lit("}"))
    found = [
        rows(customer, "Patient", c, person, nth(["Male", "female", None], c), F.when(c % 2 == 0, F.sha2(_text(c), 256)).otherwise("1980-01-01")),
        rows(supplier, "Organization", s, place),
        rows(orders, "Encounter", k, stay),
        rows(orders, "Condition", k, coded("recordedDate", nth(["A90", "i219", "Z99.9"], k))),
        rows(orders, "Procedure", k, coded("performedDateTime", F.concat(F.lit("0301"), F.lpad(_text(k % 1000000), 6, "0")))),
        rows(orders, "Observation", k, F.lit("{}")),
    ]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def _fhir(customer, supplier, orders) -> mapping.CanonicalDataset:
    return mapping.map_fhir(_resources(customer, supplier, orders))


@query(f"""SELECT 'pat_fhir_' || c_custkey AS patient_id, coalesce(lower({sql_nth(["Male", "female", None], "c_custkey")}), 'unknown') AS gender, CASE WHEN c_custkey % 2 = 0 THEN sha256(c_custkey::VARCHAR) END AS birth_date_hash,
 '12004' || (c_custkey % 10) AS municipality_code, 'AC' AS state, 'FHIR_R4' AS _source_system FROM customer""")
def fhir_patients(customer, supplier, orders):
    return _plain(_fhir(customer, supplier, orders).dim_patients)


@query("""SELECT 'org_fhir_' || s_suppkey AS organization_id, lpad(s_suppkey::VARCHAR, 7, '0') AS cnes_code, CASE WHEN s_suppkey % 5 <> 0 THEN s_name ELSE 'Organization ' || s_suppkey END AS name, 'Hospital Geral' AS facility_type,
 CAST(NULL AS VARCHAR) AS municipality_code, CAST(NULL AS VARCHAR) AS state, 50 AS bed_capacity FROM supplier""")
def fhir_organizations(customer, supplier, orders):
    return _plain(_fhir(customer, supplier, orders).dim_organizations)


@query("""SELECT 'enc_fhir_' || o_orderkey AS encounter_id, 'pat_fhir_' || o_custkey AS patient_id, 'org_fhir_' || (o_orderkey % 30) AS organization_id, CASE WHEN o_orderkey % 2 = 0 THEN 'AMB' ELSE 'EMER' END AS encounter_class,
 CASE WHEN o_orderstatus = 'P' THEN 'in-progress' ELSE 'finished' END AS status, strftime(o_orderdate, '%Y-%m-%d') AS period_start, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS period_end, 3 AS length_of_stay_days,
 CAST(NULL AS VARCHAR) AS primary_diagnosis_code, CAST(NULL AS VARCHAR) AS primary_diagnosis_chapter, CAST(NULL AS VARCHAR) AS primary_procedure_code, 1500.0::DOUBLE AS total_cost_brl, 'discharged_alive' AS discharge_disposition FROM orders""")
def fhir_encounters(customer, supplier, orders):
    return _plain(_fhir(customer, supplier, orders).fct_encounters)


_FHIR_CODE = f"CASE WHEN o_orderkey % 4 <> 0 THEN upper({sql_nth(['A90', 'i219', 'Z99.9'], 'o_orderkey')}) ELSE 'R10' END"


@query(f"""SELECT 'cond_fhir_' || o_orderkey AS condition_id, 'enc_fhir_' || o_orderkey AS encounter_id, 'pat_fhir_' || o_custkey AS patient_id, '{tables.SYSTEM_CID10}' AS code_system, d.code AS code, d.valid AS valid, d.chapter AS chapter, d.text AS chapter_description,
 'primary' AS diagnosis_rank, strftime(o_orderdate, '%Y-%m-%d') AS recorded_date FROM (SELECT *, {_diagnosis_sql(_FHIR_CODE)} AS d FROM orders)""")
def json_extract(customer, supplier, orders):
    """Codes and references out of resources' JSON, as conditions."""
    return _plain(_fhir(customer, supplier, orders).fct_conditions)


@query(f"""SELECT 'proc_fhir_' || o_orderkey AS procedure_id, 'enc_fhir_' || o_orderkey AS encounter_id, 'pat_fhir_' || o_custkey AS patient_id, '{tables.SYSTEM_SIGTAP}' AS code_system, p AS code, {_SHAPED.format("p")} AS formatted_code, {_GROUP.format("p")} AS group_description,
 'completed' AS status, strftime(o_orderdate, '%Y-%m-%d') AS performed_date FROM (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN '0301' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') ELSE '0301010010' END AS p FROM orders)""")
def fhir_procedures(customer, supplier, orders):
    return _plain(_fhir(customer, supplier, orders).fct_procedures)


def _requests(orders: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return orders.select(
        _text(k).alias("ID_SOLICITACAO"), F.when(c % 3 != 0, F.concat(F.lit("cns"), _text(c))).alias("CNS_PACIENTE"), F.concat(F.lit("cpf"), _text(c)).alias("CPF_PACIENTE"), F.when(c % 5 != 0, F.sha2(_text(c), 256)).alias("DT_NASC"), nth(["M", "F", "X", None], c).alias("SEXO"),
        F.concat(F.lit("1200"), F.lpad(_text(c % 60), 2, "0")).alias("CO_MUNICIPIO_IBGE"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("DT_SOLICITACAO"), F.when(k % 4 != 0, F.date_format(F.timestamp_add("HOUR", k % 100, F.col("o_orderdate")), "yyyy-MM-dd HH:mm:ss")).alias("DT_AUTORIZACAO"),
        nth(["leito", "consulta"], k).alias("TIPO_VAGA"), nth([*list(tables.PROCEDURES)[:6], "0909090909"], k).alias("PROCEDIMENTO_SOLICITADO"), _text(k % 50).alias("COD_ESTAB_SOLICITANTE"), nth([*list(tables.HOSPITALS)[:4], "77"], k).alias("COD_ESTAB_EXECUTANTE"),
        nth(["P", "A"], k).alias("STATUS_REGULACAO"), nth(["1", "2", "3"], k).alias("GRAU_PRIORIDADE"),
    )


_REQUEST_MPI = f"'mpi_' || substr(sha256(CASE WHEN o_custkey % 5 <> 0 THEN sha256(o_custkey::VARCHAR) || '_' || place ELSE CASE WHEN o_custkey % 3 <> 0 THEN 'cns' ELSE 'cpf' END || o_custkey END || '_{SALT}'), 1, 16)"
_R = f"(SELECT *, {_REQUEST_MPI} AS mpi, coalesce({sql_case('place', tables.MUNICIPALITIES)}, 'Município IBGE [' || place || ']') AS place_name FROM (SELECT *, '1200' || lpad((o_custkey % 60)::VARCHAR, 2, '0') AS place FROM orders))"
_REQUEST_HOSPITAL = "coalesce(" + sql_case("{0}", tables.HOSPITALS) + ", 'Hospital CNES [' || {0} || ']')"
_REQUESTED, _EXECUTING = sql_nth([*list(tables.PROCEDURES)[:6], "0909090909"], "o_orderkey"), sql_nth([*list(tables.HOSPITALS)[:4], "77"], "o_orderkey")


@query(f"""SELECT DISTINCT mpi AS patient_id, mpi AS patient_master_id, CASE {sql_nth(["M", "F", "X", None], "o_custkey")} WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' ELSE 'unknown' END AS gender, CASE WHEN o_custkey % 5 <> 0 THEN sha256(o_custkey::VARCHAR) END AS birth_date_hash,
 place AS municipality_code, place_name AS municipality_name, 'AC' AS state, 'AC' AS uf, 'sisreg_regulation' AS source_type, 'SISREG' AS _source_system FROM {_R}""")
def referral_patients(orders):
    return _plain(mapping.map_referrals(_requests(orders), SALT).dim_patients)


@query(f"""SELECT 'ref_' || o_orderkey AS referral_id, mpi AS patient_master_id, 'org_cnes_' || (o_orderkey % 50) AS request_organization_id, {_REQUEST_HOSPITAL.format("(o_orderkey % 50)::VARCHAR")} AS request_hospital_name, 'org_cnes_' || x AS executing_organization_id,
 {_REQUEST_HOSPITAL.format("x")} AS executing_hospital_name, place AS municipality_code, place_name AS municipality_name, {sql_nth(["leito", "consulta"], "o_orderkey")} AS referral_type, p AS requested_procedure_code, coalesce({sql_case("p", tables.PROCEDURES)}, 'Procedimento SUS [' || p || ']') AS requested_procedure_name,
 {sql_nth(["1", "2", "3"], "o_orderkey")} AS priority_level, {sql_nth(["P", "A"], "o_orderkey")} AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS requested_at, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate + to_hours((o_orderkey % 100)::INT), '%Y-%m-%d %H:%M:%S') END AS authorized_at,
 CASE WHEN o_orderkey % 4 <> 0 THEN round_even((o_orderkey % 100) * 3600000000::DOUBLE / 86400000000::DOUBLE, 2) ELSE 0.0::DOUBLE END AS wait_time_days, o_orderkey % 4 <> 0 AS is_authorized FROM (SELECT *, {_REQUESTED} AS p, {_EXECUTING} AS x FROM {_R})""")
def referrals(orders):
    return _plain(mapping.map_referrals(_requests(orders), SALT).fct_referrals)


_COVERED = "coalesce(" + sql_case("place", {k: str(v) for k, v in tables.POPULATION.items()}) + f", '{tables.NO_POPULATION}')::DOUBLE"


@query(f"""SELECT 'ans_plan_' || operator || '_' || place AS plan_id, operator AS ans_operator_code, c_name AS operator_name, c_mktsegment AS modality, place AS municipality_code, coalesce({sql_case("place", tables.MUNICIPALITIES)}, 'Município IBGE [' || place || ']') AS municipality_name, 'AC' AS state, '2025-01' AS competence,
 n AS active_beneficiaries, CAST(c_custkey % 70 AS INTEGER) AS elderly_beneficiaries, CAST((c_custkey * 13 % 100000) || '.5' AS DOUBLE) AS total_private_expenditure_brl, CAST((c_custkey % 90) || '.25' AS DOUBLE) AS loss_ratio_pct, round_even(n::DOUBLE * 100 / {_COVERED}, 2) AS private_coverage_ratio_pct
 FROM (SELECT *, lpad(c_custkey::VARCHAR, 6, '0') AS operator, {sql_nth([*list(tables.POPULATION)[:12], "129999"], "c_custkey")} AS place, CAST(c_custkey % 3000 AS INTEGER) AS n FROM customer)""")
def health_plans(customer):
    c = F.col("c_custkey")
    rows = customer.select(
        F.lpad(_text(c), 6, "0").alias("CD_OPERADORA"), nth([*list(tables.POPULATION)[:12], "129999"], c).alias("CD_MUNICIPIO_IBGE"), F.col("c_name").alias("RAZAO_SOCIAL"), F.col("c_mktsegment").alias("MODALIDADE_OPERADORA"), F.lit("AC").alias("SG_UF"), F.lit("2025-01").alias("COMPETENCIA"),
        _text(c % 3000).alias("NR_BENEFICIARIOS_ATIVOS"), _text(c % 70).alias("NR_BENEFICIARIOS_IDOSOS"), F.concat(_text(c * 13 % 100000), F.lit(",5")).alias("DESPESA_ASSISTENCIAL_TOTAL"), F.concat(_text(c % 90), F.lit(".25")).alias("SINISTRALIDADE_PCT"),
    )
    return _plain(mapping.map_health_plans(rows).dim_health_plans)


@query(f"""SELECT place, n, round_even(n::DOUBLE * 100 / {_COVERED}, 2) AS coverage_pct FROM (SELECT {sql_nth([*list(tables.POPULATION)[:20], "999999"], "c_nationkey")} AS place, count(*) AS n FROM customer GROUP BY 1)""")
def coverage_ratio(customer):
    per = customer.groupBy(nth([*list(tables.POPULATION)[:20], "999999"], F.col("c_nationkey")).alias("place")).agg(F.count("*").alias("n"))
    return per.withColumn("coverage_pct", terminology.coverage_ratio(F.col("n"), F.col("place")))


_LABELLED = [*list(tables.DIAGNOSES)[:10], "a90", "I21.8", "Z00", None]


@query(f"""SELECT p_partkey, {_REQUEST_HOSPITAL.format("(p_partkey % 9)::VARCHAR")} AS hospital, coalesce({sql_case("d", tables.DIAGNOSES)}, {sql_case("split_part(d, '.', 1)", tables.DIAGNOSES)}, 'Diagnóstico [' || d || ']') AS diagnosis,
 d AS code, '{tables.SYSTEM_CID10}' AS system, coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_name END, d) AS display FROM (SELECT *, upper(coalesce({sql_nth(_LABELLED, "p_partkey")}, '')) AS d FROM part)""")
def code_labels(part):
    """Labels and concepts of codes; a concept without a display shows its code."""
    k = F.col("p_partkey")
    code = F.coalesce(nth(_LABELLED, k), F.lit(""))
    made = terminology.concept(tables.SYSTEM_CID10, F.upper(code), F.when(k % 3 == 0, F.col("p_name")))["coding"][0]
    return part.select("p_partkey", terminology.hospital_label(_text(k % 9)).alias("hospital"), terminology.diagnosis_label(code).alias("diagnosis"), made["code"].alias("code"), made["system"].alias("system"), made["display"].alias("display"))
