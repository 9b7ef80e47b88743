"""The registered queries: every operator of the engine over the star-schema test tables, with the SQL that must agree.

customer stands for patients, orders for encounters (status F: expired, totalprice: cost, priority: class), lineitem for
stays and procedure lines, supplier for facilities, part for codes, nation for places. Each report query shapes these
into canonical columns and calls the report; each mapper query shapes them into a source's columns and calls the mapper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import tables, terminology
from meridian.functions.text import digits, is_hash, lookup, salted_hash, zero_pad
from meridian.operators.identity import master_patient_id
from meridian.operators.relational import keep_first
from meridian.plans import analytics
from meridian.plans.registry import MONEY, ORACLES, QUERIES, long, nth, query, quoted, sql_case, sql_nth
from meridian.streaming.landing import sessions, windowed_counts

SALT = "bench-salt"


def expired() -> Column:
    return F.col("o_orderstatus") == "F"


#: Diagnoses of made-up encounters: known ones, births, complications, unknown ones and none.
_CODES = [*list(tables.DIAGNOSES)[:16], "O80.0", "O82.1", "O84.9", "T88.7", "T88.8", "I10", "J45.9", "A90", "A91", "Z99.1", None]
_CASES = " ".join(f"WHEN c BETWEEN '{a}' AND '{b}' THEN '{name}'" for name, (a, b, _) in tables.CHAPTERS.items())


def _chapter(code: str | None) -> str | None:
    return code and next((name for name, (first, last, _) in tables.CHAPTERS.items() if first <= code[:3] <= last), "UNKNOWN")


def _coded(number: Column) -> list[Column]:
    return [nth(_CODES, number).alias("primary_diagnosis_code"), nth([_chapter(c) for c in _CODES], number).alias("primary_diagnosis_chapter")]


def _disposition() -> Column:
    return lookup(F.col("o_orderstatus"), {"F": "expired", "O": "discharged_alive"})


def _encounters(orders: DataFrame) -> DataFrame:
    """Orders as encounters: hospital, code and days follow from the key; status P has no disposition yet."""
    k = F.col("o_orderkey")
    return orders.select(
        k.cast("string").alias("encounter_id"), F.col("o_custkey").cast("string").alias("patient_id"), F.col("o_custkey").cast("string").alias("patient_master_id"),
        F.concat(F.lit("org_cnes_"), (k % 40).cast("string")).alias("organization_id"), F.col("o_orderpriority").alias("encounter_class"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("period_start"),
        F.when(k % 19 != 0, k % 37).cast("int").alias("length_of_stay_days"), F.col("o_totalprice").alias("total_cost_brl"), _disposition().alias("discharge_disposition"), *_coded(k),
    )


_E = f"""(SELECT *, CASE WHEN primary_diagnosis_code IS NOT NULL THEN CASE {_CASES} ELSE 'UNKNOWN' END END AS primary_diagnosis_chapter FROM (SELECT *, substr(primary_diagnosis_code, 1, 3) AS c FROM
 (SELECT o_orderkey::VARCHAR AS encounter_id, o_custkey::VARCHAR AS patient_id, o_custkey::VARCHAR AS patient_master_id, 'org_cnes_' || (o_orderkey % 40) AS organization_id, o_orderpriority AS encounter_class,
 strftime(o_orderdate, '%Y-%m-%d') AS period_start, CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 37 AS INTEGER) END AS length_of_stay_days, o_totalprice AS total_cost_brl,
 CASE o_orderstatus WHEN 'F' THEN 'expired' WHEN 'O' THEN 'discharged_alive' END AS discharge_disposition, {sql_nth(_CODES, "o_orderkey")} AS primary_diagnosis_code FROM orders)))"""


def _stays(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines as hospital stays: supplier as hospital, days from order to shipping."""
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("encounter_id"), F.col("o_custkey").cast("string").alias("patient_master_id"), F.concat(F.lit("org_cnes_"), F.col("l_suppkey").cast("string")).alias("organization_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("period_start"), F.date_diff("l_shipdate", "o_orderdate").alias("length_of_stay_days"), F.col("l_extendedprice").alias("total_cost_brl"), _disposition().alias("discharge_disposition"), *_coded(F.col("l_partkey")),
    )


_S = f"""(SELECT *, CASE WHEN primary_diagnosis_code IS NOT NULL THEN CASE {_CASES} ELSE 'UNKNOWN' END END AS primary_diagnosis_chapter FROM (SELECT *, substr(primary_diagnosis_code, 1, 3) AS c FROM
 (SELECT l_orderkey || '-' || l_linenumber AS encounter_id, o_custkey::VARCHAR AS patient_master_id, 'org_cnes_' || l_suppkey AS organization_id, strftime(o_orderdate, '%Y-%m-%d') AS period_start,
 date_diff('day', o_orderdate, l_shipdate) AS length_of_stay_days, l_extendedprice AS total_cost_brl, CASE o_orderstatus WHEN 'F' THEN 'expired' WHEN 'O' THEN 'discharged_alive' END AS discharge_disposition,
 {sql_nth(_CODES, "l_partkey")} AS primary_diagnosis_code FROM lineitem JOIN orders ON l_orderkey = o_orderkey)))"""

#: Places of made-up patients and hospitals: nation n lies in 120000 + n.
_PLACES = [str(120000 + n) for n in range(25)]


def _persons(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return customer.select(c.cast("string").alias("patient_id"), c.cast("string").alias("patient_master_id"), nth(["male", "female", None, "unknown"], c).alias("gender"), F.when(c % 9 != 0, (F.col("c_nationkey") + 120000).cast("string")).alias("municipality_code"))


_P = f"(SELECT c_custkey::VARCHAR AS patient_master_id, {sql_nth(['male', 'female', None, 'unknown'], 'c_custkey')} AS gender, CASE WHEN c_custkey % 9 <> 0 THEN (c_nationkey + 120000)::VARCHAR END AS municipality_code FROM customer)"


def _hospitals(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(F.concat(F.lit("org_cnes_"), k.cast("string")).alias("organization_id"), F.when(F.col("s_nationkey") != 7, (F.col("s_nationkey") + 120000).cast("string")).alias("municipality_code"), F.when(k % 6 != 0, k % 90 + 10).cast("int").alias("bed_capacity"))


_H = "(SELECT 'org_cnes_' || s_suppkey AS organization_id, CASE WHEN s_nationkey <> 7 THEN (s_nationkey + 120000)::VARCHAR END AS municipality_code, CASE WHEN s_suppkey % 6 <> 0 THEN CAST(s_suppkey % 90 + 10 AS INTEGER) END AS bed_capacity FROM supplier)"
_DEATHS = "CAST(count_if(coalesce(discharge_disposition = 'expired', false)) AS BIGINT)"
_COST = MONEY.format("total_cost_brl")
_DX_LABEL = "coalesce(" + sql_case("primary_diagnosis_code", tables.DIAGNOSES) + ", " + sql_case("split_part(primary_diagnosis_code, '.', 1)", tables.DIAGNOSES) + ", 'Diagnóstico [' || primary_diagnosis_code || ']')"
_HOSPITAL_LABEL = "coalesce(" + sql_case("replace(organization_id, 'org_cnes_', '')", tables.HOSPITALS) + ", 'Hospital CNES [' || replace(organization_id, 'org_cnes_', '') || ']')"


@query(f"""SELECT count(*) AS admissions, {_COST} AS total_cost, {_COST} / count(total_cost_brl) AS mean_cost, median(total_cost_brl) AS median_cost, avg(length_of_stay_days) AS mean_days,
 CAST(median(length_of_stay_days) AS DOUBLE) AS median_days, {_DEATHS} AS deaths, {_DEATHS} * 100.0::DOUBLE / count(*) AS mortality_pct FROM {_E}""")
def global_kpis(orders):
    return analytics.global_kpis(_encounters(orders))


@query(f"SELECT encounter_class, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct FROM {_E} WHERE encounter_class IS NOT NULL GROUP BY 1")
def class_share(orders):
    return analytics.class_share(_encounters(orders))


@query(f"SELECT primary_diagnosis_chapter, count(*) AS n FROM {_S} WHERE primary_diagnosis_chapter IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def top_codes(lineitem, orders):
    return analytics.top_chapters(_stays(lineitem, orders))


@query(f"""SELECT *, {_DX_LABEL} AS label FROM (SELECT primary_diagnosis_code, primary_diagnosis_chapter, count(*) AS cases, {_DEATHS} AS deaths, {_COST} / count(total_cost_brl) AS mean_cost, avg(length_of_stay_days) AS mean_days,
 {_DEATHS} * 100.0::DOUBLE / count(*) AS lethality_pct FROM {_S} WHERE primary_diagnosis_code IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 10 ORDER BY lethality_pct DESC, cases DESC, 1, 2 LIMIT 10)""")
def lethal_codes(lineitem, orders):
    return analytics.lethal_diagnoses(_stays(lineitem, orders))


@query(f"""SELECT primary_diagnosis_code, {_COST} AS total_cost, count(*) AS cases, {_COST} / count(total_cost_brl) AS mean_cost, min(primary_diagnosis_chapter) AS chapter
 FROM {_S} WHERE primary_diagnosis_code IS NOT NULL GROUP BY 1 ORDER BY total_cost DESC, 1 LIMIT 10""")
def cost_codes(lineitem, orders):
    return analytics.costly_diagnoses(_stays(lineitem, orders))


@query(f"""SELECT *, {_HOSPITAL_LABEL} AS hospital FROM (SELECT organization_id, count(*) AS admissions, {_COST} AS total_cost, {_DEATHS} AS deaths, avg(length_of_stay_days) AS mean_days, {_DEATHS} * 100.0::DOUBLE / count(*) AS mortality_pct
 FROM {_S} GROUP BY 1 ORDER BY admissions DESC, organization_id LIMIT 10)""")
def org_concentration(lineitem, orders):
    return analytics.hospital_concentration(_stays(lineitem, orders))


@query(f"SELECT gender, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct FROM {_E} LEFT JOIN {_P} USING (patient_master_id) WHERE gender IS NOT NULL GROUP BY 1")
def demography(orders, customer):
    return analytics.demography(_encounters(orders), _persons(customer))[0]


@query(f"""SELECT *, coalesce({sql_case("municipality_code", tables.MUNICIPALITIES)}, 'Município IBGE [' || municipality_code || ']') AS municipality FROM
 (SELECT municipality_code, count(*) AS n FROM {_E} LEFT JOIN {_P} USING (patient_master_id) WHERE municipality_code IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5)""")
def demography_places(orders, customer):
    return analytics.demography(_encounters(orders), _persons(customer))[1]


@query(f"""SELECT count(*) AS patients, CAST(count_if(n > 1) AS BIGINT) AS readmitted, CAST(count_if(n > 1) AS BIGINT) * 100.0::DOUBLE / count(*) AS readmitted_pct, max(n) AS most
 FROM (SELECT patient_master_id, count(*) AS n FROM {_E} GROUP BY 1)""")
def readmissions(orders):
    return analytics.readmissions(_encounters(orders))


@query(f"""WITH e AS {_E}, top AS (SELECT patient_master_id, {_COST} AS patient_total FROM e GROUP BY 1 ORDER BY patient_total DESC, 1 LIMIT 1)
 SELECT patient_master_id, encounter_id, period_start, total_cost_brl, patient_total, CAST(row_number() OVER (PARTITION BY patient_master_id ORDER BY period_start, encounter_id) AS BIGINT) AS step FROM e JOIN top USING (patient_master_id)""")
def super_user_journey(orders):
    return analytics.super_user(_encounters(orders)).select("patient_master_id", "encounter_id", "period_start", "total_cost_brl", "patient_total", long(F.col("step")).alias("step"))


@query(f"""SELECT patient_master_id, sum(n)::BIGINT AS encounters, count(*) AS hospitals, string_agg(organization_id, '|' ORDER BY first) AS hospital_list FROM
 (SELECT patient_master_id, organization_id, count(*) AS n, min((period_start, encounter_id)) AS first FROM {_E} GROUP BY 1, 2) GROUP BY 1 HAVING count(*) > 1""")
def multi_org_patients(orders):
    return analytics.multi_hospital(_encounters(orders)).withColumn("hospital_list", F.array_join("hospital_list", "|"))


def _conditions(lineitem, part):
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").cast("string").alias("encounter_id"), F.when(F.col("p_brand") == "Brand#11", "0000").otherwise(F.col("p_type")).alias("code"))


def _procedures(lineitem):
    return lineitem.filter("l_quantity > 30").select(F.col("l_orderkey").cast("string").alias("encounter_id"), F.concat_ws("-", "l_returnflag", "l_linestatus").alias("code"))


@query(f"""SELECT encounter_id, patient_master_id, CAST(row_number() OVER (PARTITION BY patient_master_id ORDER BY period_start, encounter_id) AS BIGINT) AS step, conditions, procedures FROM {_E}
 LEFT JOIN (SELECT l_orderkey::VARCHAR AS encounter_id, string_agg(p_type, '|' ORDER BY p_type) AS conditions FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> 'Brand#11' GROUP BY 1) USING (encounter_id)
 LEFT JOIN (SELECT l_orderkey::VARCHAR AS encounter_id, string_agg(l_returnflag || '-' || l_linestatus, '|' ORDER BY l_returnflag || '-' || l_linestatus) AS procedures FROM lineitem WHERE l_quantity > 30 GROUP BY 1) USING (encounter_id)""")
def journey_nested(orders, lineitem, part):
    out = analytics.journey_details(_encounters(orders), _conditions(lineitem, part), _procedures(lineitem))
    return out.select("encounter_id", "patient_master_id", long(F.col("step")).alias("step"), F.array_join("condition_codes", "|").alias("conditions"), F.array_join("procedure_codes", "|").alias("procedures"))


@query(f"""WITH e AS {_E} SELECT patient_master_id, count(*) AS encounters, count(DISTINCT organization_id) AS hospitals FROM e WHERE patient_master_id IN (SELECT patient_master_id FROM e WHERE discharge_disposition = 'expired')
 GROUP BY 1 HAVING count(*) > 1 OR count(DISTINCT organization_id) > 1""")
def expired_semi(orders):
    return analytics.expired_journeys(_encounters(orders))


_SEQUENCE = f"""SELECT patient_master_id, first, last, hospitals FROM (SELECT patient_master_id, arg_min(coalesce(discharge_disposition, '-'), (period_start, encounter_id)) AS first, arg_max(coalesce(discharge_disposition, '-'), (period_start, encounter_id)) AS last,
 count(DISTINCT organization_id) AS hospitals FROM {_E} GROUP BY 1) WHERE first = 'discharged_alive' AND last = 'expired' AND hospitals > 1"""


@query(_SEQUENCE)
def sequence_first_last(orders):
    return analytics.alive_then_expired(_encounters(orders), None)


@query(_SEQUENCE + " ORDER BY patient_master_id LIMIT 1")
def sequence_first_hit(orders):
    return analytics.alive_then_expired(_encounters(orders), 1)


_PROCEDURE_CODES = [*list(tables.PROCEDURES)[:20], "0201010099", "0202030040", "0909090909", None]


def _ambulatory(lineitem):
    """Lines as ambulatory procedures; amounts are texts, as the extracts have them."""
    return lineitem.select(nth(_PROCEDURE_CODES, F.col("l_partkey")).alias("PA_PROC_ID"), F.col("l_quantity").cast("string").alias("PA_QTDPRO"), F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")).alias("PA_VALPRO"))


@query(f"""SELECT v AS primary_visits, q AS ambulatory_procedures, cost AS ambulatory_cost, o.n AS admissions, o.cost2 AS hospital_cost, v / greatest(1, o.n)::DOUBLE AS visits_per_admission, cost * 100 / (cost + o.cost2) AS ambulatory_cost_pct
 FROM (SELECT {MONEY.format("user_id % 10")} AS v FROM events) e, (SELECT {MONEY.format("l_quantity")} AS q, {MONEY.format("l_extendedprice")} AS cost FROM lineitem) l, (SELECT count(*) AS n, {_COST} AS cost2 FROM {_E}) o""")
def care_pyramid(events, lineitem, orders):
    return analytics.care_pyramid(events.select((F.col("user_id") % 10).cast("string").alias("QT_ATENDIMENTOS")), _ambulatory(lineitem), _encounters(orders))


@query(f"""SELECT organization_id, days, admissions, beds, days * 100.0::DOUBLE / (beds * 31) AS occupancy_pct, admissions / beds::DOUBLE AS turnover FROM (SELECT organization_id, CAST(sum(length_of_stay_days) AS BIGINT) AS days, count(*) AS admissions FROM {_S} GROUP BY 1)
 JOIN (SELECT organization_id, max(bed_capacity) AS beds FROM {_H} WHERE bed_capacity > 0 GROUP BY 1) USING (organization_id)""")
def occupancy(lineitem, orders, supplier):
    return analytics.occupancy(_stays(lineitem, orders), _hospitals(supplier))


@query(f"""SELECT e.n AS notified, l.q AS exams, o.n AS admitted, o.n * 100.0::DOUBLE / greatest(1, e.n) AS admitted_pct FROM (SELECT count(*) AS n FROM events WHERE event_type = 'click') e,
 (SELECT {MONEY.format("l_quantity")} AS q FROM lineitem WHERE left({sql_nth(_PROCEDURE_CODES, "l_partkey")}, 4) IN ('0201', '0202')) l,
 (SELECT CAST(count_if(left(primary_diagnosis_code, 3) IN ('A90', 'A91')) AS BIGINT) AS n FROM {_E}) o""")
def funnel(events, lineitem, orders):
    return analytics.dengue_funnel(events.filter("event_type = 'click'"), _ambulatory(lineitem), _encounters(orders))


_HIT = "coalesce(substr(primary_diagnosis_code, 1, 3) IN (" + ", ".join(map(quoted, analytics.AVOIDABLE)) + "), false)"


@query(f"SELECT CAST(count_if({_HIT}) AS BIGINT) AS avoidable, CAST(count_if({_HIT}) AS BIGINT) * 100.0::DOUBLE / count(*) AS avoidable_pct, {MONEY.format(f'CASE WHEN {_HIT} THEN total_cost_brl ELSE 0 END')} AS avoidable_cost FROM {_E}")
def code_set_share(orders):
    return analytics.avoidable(_encounters(orders))


_MOVED = f"""(SELECT p.municipality_code AS home_place, h.municipality_code AS hospital_place, coalesce(p.municipality_code <> h.municipality_code, true) AS travelled
 FROM {_S} s LEFT JOIN {_P} p USING (patient_master_id) LEFT JOIN {_H} h USING (organization_id))"""


def _moved(lineitem, orders, customer, supplier):
    """Stays with home and hospital place; nation 7 stands for an unknown hospital place."""
    return analytics.migration(_stays(lineitem, orders), _persons(customer), _hospitals(supplier))


@query(f"SELECT CAST(count_if(travelled) AS BIGINT) AS travelled, count(*) AS encounters, CAST(count_if(travelled) AS BIGINT) * 100.0::DOUBLE / count(*) AS travelled_pct FROM {_MOVED}")
def migration_rate(lineitem, orders, customer, supplier):
    return analytics.migration_rate(_moved(lineitem, orders, customer, supplier))


_BOTH = "travelled AND home_place IS NOT NULL AND hospital_place IS NOT NULL"


@query(f"SELECT home_place, hospital_place, count(*) AS n FROM {_MOVED} WHERE {_BOTH} GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 8")
def migration_routes(lineitem, orders, customer, supplier):
    return analytics.migration_routes(_moved(lineitem, orders, customer, supplier))


@query(f"SELECT home_place, {', '.join(f'CAST(count_if(hospital_place = {quoted(k)}) AS BIGINT) AS to_{k}' for k in _PLACES)} FROM {_MOVED} WHERE {_BOTH} GROUP BY 1")
def migration_matrix(lineitem, orders, customer, supplier):
    """All travellers by home and by hospital, over every place that a nation can lie in."""
    return analytics.migration_matrix(_moved(lineitem, orders, customer, supplier), _PLACES).withColumnsRenamed({k: f"to_{k}" for k in _PLACES})


@query(f"SELECT home_place, hospital_place, count(*) AS n FROM {_MOVED} WHERE {_BOTH} GROUP BY 1, 2")
def migration_flows(lineitem, orders, customer, supplier):
    return analytics.migration_flows(_moved(lineitem, orders, customer, supplier))


@query(f"""SELECT CAST(a AS BIGINT) AS normal, CAST(b AS BIGINT) AS cesarean, b * 100.0::DOUBLE / greatest(1, a + b) AS cesarean_pct FROM
 (SELECT count_if(primary_diagnosis_code = 'O80.0') AS a, count_if(starts_with(primary_diagnosis_code, 'O82') OR starts_with(primary_diagnosis_code, 'O84')) AS b FROM {_S})""")
def binary_mode_share(lineitem, orders):
    return analytics.birth_modes(_stays(lineitem, orders))


_LONG_COST = MONEY.format("CASE WHEN coalesce(length_of_stay_days > 60, false) THEN total_cost_brl ELSE 0 END")


@query(f"""SELECT CAST(count_if(length_of_stay_days > 60) AS BIGINT) AS long_stays, CAST(count_if(length_of_stay_days > 60) AS BIGINT) * 100.0::DOUBLE / count(*) AS long_pct, {_LONG_COST} AS long_cost, {_LONG_COST} * 100 / {_COST} AS long_cost_pct FROM {_S}""")
def long_tail(lineitem, orders):
    return analytics.long_stays(_stays(lineitem, orders), 60)


@query(f"""SELECT PA_PROC_ID, n, coalesce({sql_case("PA_PROC_ID", tables.PROCEDURES)}, 'Procedimento SUS [' || PA_PROC_ID || ']') AS label FROM
 (SELECT {sql_nth(_PROCEDURE_CODES, "l_partkey")} AS PA_PROC_ID, count(*) AS n FROM lineitem GROUP BY 1) WHERE PA_PROC_ID IS NOT NULL ORDER BY n DESC, 1 LIMIT 10""")
def top_ambulatory(lineitem):
    return analytics.top_ambulatory(_ambulatory(lineitem))


@query(f"""SELECT band, band_order, count(*) AS n, {_COST} / count(total_cost_brl) AS mean_cost, {_DEATHS} * 100.0::DOUBLE / count(*) AS mortality_pct FROM (SELECT *, CASE WHEN a <= 12 THEN '(0, 12]' WHEN a <= 19 THEN '(12, 19]' WHEN a <= 59 THEN '(19, 59]' ELSE '(59, 120]' END AS band,
 CASE WHEN a <= 12 THEN 0 WHEN a <= 19 THEN 1 WHEN a <= 59 THEN 2 ELSE 3 END AS band_order FROM (SELECT *, patient_id::BIGINT % 131 AS a FROM {_E}) WHERE a > 0 AND a <= 120) GROUP BY 1, 2""")
def bands(orders):
    return analytics.age_bands(_encounters(orders).withColumn("IDADE", (F.col("patient_id").cast("long") % 131).cast("string")))


@query("SELECT p_partkey::VARCHAR AS encounter_id, p_name AS patient_id, p_brand AS organization_id, p_type AS primary_diagnosis_code, p_retailprice AS total_cost_brl FROM part WHERE starts_with(p_type, 'S')")
def prefix_listing(part):
    return analytics.complications(part.select(F.col("p_partkey").cast("string").alias("encounter_id"), F.col("p_name").alias("patient_id"), F.col("p_brand").alias("organization_id"), F.col("p_type").alias("primary_diagnosis_code"), F.col("p_retailprice").alias("total_cost_brl")), "S")


@query(f"SELECT encounter_id, patient_id, organization_id, primary_diagnosis_code, total_cost_brl FROM {_E} WHERE starts_with(primary_diagnosis_code, 'T88')")
def complications(orders):
    return analytics.complications(_encounters(orders))


@query(f"SELECT discharge_disposition, count(*) AS n FROM {_E} WHERE discharge_disposition IS NOT NULL GROUP BY 1")
def dispositions(orders):
    return analytics.dispositions(_encounters(orders))


_CHAPTER_LABEL = _DX_LABEL.replace("'Diagnóstico [' || primary_diagnosis_code || ']'", "'Diagnóstico [' || coalesce(primary_diagnosis_code, '') || ']' || coalesce(' (' || primary_diagnosis_chapter || ')', '')")


@query(f"""SELECT encounter_id, {_CHAPTER_LABEL} AS diagnosis_name, coalesce({sql_case("p", tables.PROCEDURES)}, 'Procedimento SUS [' || coalesce(p, '') || ']') AS procedure_name, {_HOSPITAL_LABEL} AS hospital_name
 FROM (SELECT *, {sql_nth(_PROCEDURE_CODES, "encounter_id::BIGINT")} AS p FROM {_E})""")
def enriched_encounters(orders):
    e = _encounters(orders)
    e = e.withColumn("primary_procedure_code", nth(_PROCEDURE_CODES, F.col("encounter_id").cast("long")))
    return analytics.enriched(e).select("encounter_id", "diagnosis_name", "procedure_name", "hospital_name")


@query("""SELECT s_suppkey, coalesce(n_name, 'Place [' || s_nationkey || ']') AS place, CASE n_name WHEN 'NATION_1' THEN 'one' WHEN 'NATION_2' THEN 'two' ELSE 'other' END AS kind
 FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 20""")
def label_enrichment(supplier, nation):
    named = supplier.join(nation.filter("n_nationkey < 20"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return named.select("s_suppkey", F.coalesce("n_name", F.concat(F.lit("Place ["), F.col("s_nationkey").cast("string"), F.lit("]"))).alias("place"), lookup(F.col("n_name"), {"NATION_1": "one", "NATION_2": "two"}, F.lit("other")).alias("kind"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS source, count(*) AS n FROM {t}" for t in ("orders", "lineitem", "supplier", "customer", "events")))
def volumes(orders, lineitem, supplier, customer, events):
    return analytics.volumes({"orders": orders, "lineitem": lineitem, "supplier": supplier, "customer": customer, "events": events})


@query(f"SELECT c_custkey, sha256(trim(c_name) || '{SALT}') AS c_name FROM customer")
def pii_hash(customer):
    from meridian.operators.privacy import anonymize

    return anonymize(customer.select("c_custkey", "c_name"), ["c_name"], SALT)[0]


_MPI = f"""SELECT c_custkey, CASE WHEN b IS NOT NULL AND c_nationkey IS NOT NULL THEN 'mpi_' || substr(sha256(b || '_' || c_nationkey || '_{SALT}'), 1, 16)
 ELSE 'mpi_' || substr(sha256(c_custkey || '_{SALT}'), 1, 16) END AS patient_master_id FROM (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 <> 0 THEN sha256(c_mktsegment || '{SALT}') END AS b FROM customer)"""


def _mpi(customer):
    birth = F.when(F.col("c_custkey") % 3 != 0, salted_hash(F.col("c_mktsegment"), SALT))
    return customer.select("c_custkey", master_patient_id(F.col("c_custkey").cast("string"), birth, F.col("c_nationkey").cast("string"), SALT).alias("patient_master_id"))


@query(_MPI)
def mpi_key(customer):
    return _mpi(customer)


@query(f"""SELECT o_orderkey, coalesce(patient_master_id, 'mpi_' || substr(sha256(o_custkey || '_{SALT}'), 1, 16)) AS patient_master_id
 FROM orders LEFT JOIN (SELECT * FROM ({_MPI}) WHERE c_custkey % 5 <> 0) ON o_custkey = c_custkey""")
def mpi_enrichment(orders, customer):
    from meridian.operators.identity import enrich

    ids = _mpi(customer).filter("c_custkey % 5 <> 0").withColumn("patient_id", F.col("c_custkey").cast("string"))
    facts = orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("patient_id"))
    return enrich(facts, ids, SALT).select("o_orderkey", "patient_master_id")


@query(f"""SELECT CAST(count_if(regexp_full_match(h, '[0-9a-f]{{64}}')) AS BIGINT) AS hashed, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN sha256(c_name || '{SALT}') ELSE c_name END AS h FROM customer)""")
def hash_shape(customer):
    h = F.when(F.col("c_custkey") % 2 == 0, salted_hash(F.col("c_name"), SALT)).otherwise(F.col("c_name"))
    return customer.agg(F.count_if(is_hash(h)).alias("hashed"), F.count("*").alias("n"))


@query(f"""SELECT p_partkey, raw, valid, CASE WHEN NOT valid THEN raw WHEN length(raw) = 3 THEN raw ELSE c || '.' || substr(raw, 4) END AS code, CASE WHEN valid THEN CASE {_CASES} ELSE 'UNKNOWN' END END AS chapter FROM
 (SELECT p_partkey, raw, substr(raw, 1, 3) AS c, regexp_full_match(substr(raw, 1, 3), '[A-Z][0-9]{{2}}') AS valid FROM
 (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'X' ELSE '' END || chr((65 + p_partkey % 26)::INT) || lpad((p_partkey % 100)::VARCHAR, 2, '0') || CASE WHEN p_partkey % 3 = 0 THEN (p_partkey % 10)::VARCHAR ELSE '' END AS raw FROM part))""")
def cid_normalise(part):
    k = F.col("p_partkey")
    raw = F.concat(F.when(k % 11 == 0, "X").otherwise(""), F.char((k % 26 + 65).cast("int")), F.lpad((k % 100).cast("string"), 2, "0"), F.when(k % 3 == 0, (k % 10).cast("string")).otherwise(""))
    return part.select("p_partkey", raw.alias("raw")).withColumn("d", terminology.diagnosis(F.lower("raw"))).select("p_partkey", "raw", "d.valid", "d.code", "d.chapter")


_GROUPS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tables.PROCEDURE_GROUPS.items())


@query(f"""SELECT p_partkey, c AS code, substr(c,1,2)||'.'||substr(c,3,2)||'.'||substr(c,5,2)||'.'||substr(c,7,3)||'-'||substr(c,10,1) AS formatted,
 CASE substr(c,1,2) {_GROUPS} ELSE '{tables.NO_GROUP}' END AS group_description FROM (SELECT p_partkey, '0' || (1 + p_partkey % 9) || lpad((p_partkey * 37 % 100000000)::VARCHAR, 8, '0') AS c FROM part)""")
def sigtap_format(part):
    k = F.col("p_partkey")
    nine = F.concat((k % 9 + 1).cast("string"), F.lpad((k * 37 % 100000000).cast("string"), 8, "0"))
    raw = F.when(k % 2 == 0, nine).otherwise(F.concat(F.lit("0"), nine))
    return part.select("p_partkey", terminology.procedure(raw).alias("p")).select("p_partkey", "p.code", "p.formatted", "p.group_description")


_STATES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tables.STATES.items())


@query(f"""SELECT c_custkey, valid, CASE WHEN valid THEN substr(d, 1, 6) ELSE d END AS code, CASE WHEN valid THEN CASE substr(d, 1, 2) {_STATES} ELSE 'BR' END END AS state FROM
 (SELECT *, length(d) IN (6, 7) AS valid FROM (SELECT c_custkey, (10 + c_custkey % 50)::VARCHAR || lpad((c_custkey % 10000)::VARCHAR, CASE WHEN c_custkey % 3 = 0 THEN 5 WHEN c_custkey % 7 = 0 THEN 7 ELSE 4 END, '0') AS d FROM customer))""")
def ibge_normalise(customer):
    k = F.col("c_custkey")
    tail = (k % 10000).cast("string")
    raw = F.concat((k % 50 + 10).cast("string"), F.when(k % 3 == 0, F.lpad(tail, 5, "0")).when(k % 7 == 0, F.lpad(tail, 7, "0")).otherwise(F.lpad(tail, 4, "0")))
    return customer.select("c_custkey", terminology.municipality(raw).alias("m")).select("c_custkey", "m.valid", "m.code", "m.state")


@query("""SELECT p_partkey, try_cast(replace(s, ',', '.') AS DOUBLE) AS cost, coalesce(try_cast(replace(s, ',', '.') AS DOUBLE), 0.0::DOUBLE) AS cost_or_zero FROM
 (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'n/a' ELSE (p_partkey % 1000)::VARCHAR || ',' || lpad((p_partkey % 100)::VARCHAR, 2, '0') END AS s FROM part)""")
def safe_casts(part):
    from meridian.functions.text import decimal_number

    k = F.col("p_partkey")
    s = F.when(k % 4 == 0, "n/a").otherwise(F.concat((k % 1000).cast("string"), F.lit(","), F.lpad((k % 100).cast("string"), 2, "0")))
    return part.select("p_partkey", decimal_number(s).alias("cost")).withColumn("cost_or_zero", F.coalesce("cost", F.lit(0.0)))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders")
def date_parse(orders):
    compact = F.when(F.col("o_orderkey") % 5 == 0, "00000000").otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".0")))
    return orders.select("o_orderkey", terminology.compact_date(compact).alias("d"))


@query("""SELECT o_orderkey, CASE WHEN c IN ('02', '3') THEN 'EMER' WHEN c = '1' THEN 'AMB' ELSE 'IMP' END AS class, CASE WHEN c = '1' THEN 'male' WHEN c = '3' THEN 'female' ELSE 'other' END AS gender
 FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '02' WHEN 1 THEN '1' WHEN 2 THEN '3' ELSE '9' END AS c FROM orders)""")
def recode_class(orders):
    k = F.col("o_orderkey") % 4
    c = F.when(k == 0, "02").when(k == 1, "1").when(k == 2, " 3 ").otherwise("9")
    return orders.select("o_orderkey", terminology.encounter_class(c).alias("class"), terminology.gender(c).alias("gender"))


@query("""SELECT o_orderkey, coalesce(date_diff('day', o_orderdate, first), 0)::DOUBLE AS wait_days, first IS NOT NULL AS is_authorized
 FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) ON l_orderkey = o_orderkey""")
def wait_time(orders, lineitem):
    first = lineitem.filter("l_returnflag <> 'N'").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first"))
    joined = orders.join(first, orders.o_orderkey == first.l_orderkey, "left")
    return joined.select("o_orderkey", terminology.days_between(F.col("first").cast("string"), F.col("o_orderdate").cast("string")).alias("wait_days"), F.col("first").isNotNull().alias("is_authorized"))


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def keep_first_order(orders):
    return keep_first(orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


def _split(events):
    from meridian.operators.validation import Rules, validate

    rows = events.select("event_id", F.expr("nullif(event_type, 'view')").alias("event_type"))
    return validate(rows, "events", {"events": Rules(required=("event_id",), keys=("event_id",), allowed={"event_type": ("click", "purchase")})})


@query("SELECT event_id, event_type FROM (SELECT event_id, nullif(event_type, 'view') AS event_type FROM events) WHERE event_type IN ('click', 'purchase')")
def valid_split(events):
    return _split(events).valid


@query("SELECT event_id, event_type FROM (SELECT event_id, nullif(event_type, 'view') AS event_type FROM events) WHERE coalesce(event_type NOT IN ('click', 'purchase'), true)")
def rejected_split(events):
    return _split(events).rejected


@query("SELECT l_returnflag, CAST(count_if(l_linestatus = 'F') AS BIGINT) AS f, CAST(count_if(l_linestatus = 'O') AS BIGINT) AS o FROM lineitem GROUP BY 1")
def conditional_pivot(lineitem):
    out = lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count().na.fill(0)
    return out.select("l_returnflag", F.col("F").alias("f"), F.col("O").alias("o"))


@query("SELECT DISTINCT CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month FROM lineitem")
def distinct_partitions(lineitem):
    return lineitem.select(long(F.year("l_shipdate")).alias("year"), long(F.month("l_shipdate")).alias("month")).distinct()


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')")
def patients_without_encounter(customer, orders):
    """Patients without an urgent encounter that is still open."""
    urgent = orders.filter("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    return customer.join(urgent, customer.c_custkey == urgent.o_custkey, "left_anti").select("c_custkey", "c_name")


@query(f"""SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, {MONEY.format("round(value, 2)")} AS total FROM events GROUP BY 1, 2""")
def event_windows(events):
    return windowed_counts(events.withColumn("value", F.round("value", 2).cast("decimal(18,2)"))).withColumn("total", F.col("total").cast("double"))


@query("""SELECT w AS window_start, event_type, count(*) AS n FROM (SELECT event_type, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 12 HOUR, date_trunc('day', ts) + INTERVAL 12 HOUR]) AS w, ts FROM events)
 WHERE ts >= w AND ts < w + INTERVAL 1 DAY GROUP BY 1, 2""")
def sliding_windows(events):
    """Windows of a day that begin every twelve hours."""
    return windowed_counts(events, "1 day", slide="12 hours").select("window_start", "event_type", "n")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > ts - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
 g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e)
 SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n FROM g GROUP BY user_id, g""")
def session_windows(events):
    return sessions(events, "6 hours")


@query("SELECT n_name, CAST(count_if(contains(n_name, '1')) AS BIGINT) AS with_one, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def contains_filter(nation, customer):
    has = F.coalesce(F.col("n_name").contains("1"), F.lit(False))
    return nation.join(customer, nation.n_nationkey == customer.c_nationkey).groupBy("n_name").agg(F.count_if(has).alias("with_one"), F.count("*").alias("n"))


@query("SELECT s_suppkey, CASE WHEN length(d) >= 7 THEN d ELSE lpad(d, 7, '0') END AS cnes FROM (SELECT s_suppkey, regexp_replace(s_name, '[^0-9]', '', 'g') AS d FROM supplier)")
def zero_padding(supplier):
    return supplier.select("s_suppkey", zero_pad(digits(F.col("s_name")), 7).alias("cnes"))


@query("SELECT p_partkey, md5(p_name || '|' || p_brand) AS fingerprint FROM part")
def md5_fingerprint(part):
    return part.select("p_partkey", F.md5(F.concat_ws("|", "p_name", "p_brand")).alias("fingerprint"))


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def places_with_both(customer, supplier):
    return customer.select(F.col("c_nationkey").alias("nation")).intersect(supplier.select("s_nationkey"))


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def patients_never_expired(customer, orders):
    return customer.select("c_custkey").subtract(orders.filter(expired()).select("o_custkey"))


@query("SELECT 'patient' AS kind, c_custkey AS id, c_nationkey AS place, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL SELECT 'facility', s_suppkey, s_nationkey, s_acctbal FROM supplier")
def union_by_name(customer, supplier):
    a = customer.select(F.lit("patient").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("place"))
    b = supplier.select(F.col("s_nationkey").alias("place"), F.col("s_suppkey").alias("id"), F.lit("facility").alias("kind"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT p_partkey, list_extract(list_filter(string_split(p_name, ' '), lambda w: length(w) > 3), -1) AS last_long, string_split(p_name, ' ')[1] AS first FROM part")
def array_elements(part):
    words = F.split("p_name", " ")
    return part.select("p_partkey", F.try_element_at(F.filter(words, lambda w: F.length(w) > 3), F.lit(-1)).alias("last_long"), F.try_element_at(words, F.lit(1)).alias("first"))


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 5")
def preview(orders):
    return orders.select("o_orderkey", "o_orderdate").orderBy(F.desc_nulls_last("o_orderdate"), "o_orderkey").limit(5)


@query("SELECT c_custkey, n_nationkey IS NULL AS unplaced, coalesce(s.n, 0) AS facilities FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 1 LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON c_nationkey = s_nationkey")
def null_tests(customer, nation, supplier):
    per = supplier.groupBy("s_nationkey").agg(F.count("*").alias("n"))
    placed = customer.join(nation.filter("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(per, F.col("c_nationkey") == F.col("s_nationkey"), "left")
    return placed.select("c_custkey", F.col("n_nationkey").isNull().alias("unplaced"), F.coalesce("n", F.lit(0).cast("long")).alias("facilities"))


_LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in (("EMER", "Urgência / Emergência"), ("IMP", "Internação Eletiva"), ("AMB", "Ambulatorial")))


@query(f"""SELECT o_orderkey, class AS encounter_class, CASE class {_LABELS} ELSE 'Outros' END AS encounter_class_name, CASE o_orderstatus WHEN 'F' THEN 'Óbito Hospitalar' WHEN 'O' THEN 'Alta Hospitalar com Vida' ELSE 'Em Tratamento' END AS discharge_disposition_name
 FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'EMER' WHEN 1 THEN 'IMP' WHEN 2 THEN 'AMB' ELSE 'X' END AS class FROM orders)""")
def export_labels(orders):
    from meridian.plans.export import labelled

    k = F.col("o_orderkey") % 4
    rows = orders.select("o_orderkey", F.when(k == 0, "EMER").when(k == 1, "IMP").when(k == 2, "AMB").otherwise("X").alias("encounter_class"), lookup(F.col("o_orderstatus"), {"F": "expired", "O": "discharged_alive"}, F.lit("open")).alias("discharge_disposition"))
    return labelled(rows, "fct_encounters").drop("discharge_disposition")


from meridian.plans import io_queries, mapper_queries  # noqa: E402, F401 - they register their own
