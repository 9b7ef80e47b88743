"""Registered queries of sources, sinks, jobs and streams: rows go through a writer or a job and are read back, and SQL
says what must come out. What they write goes to a folder of their own in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions import tables, terminology
from meridian.functions.tables import PERSONAL
from meridian.operators import identity, mapping, privacy
from meridian.operators.validation import validate
from meridian.plans import mapper_queries as shapes
from meridian.plans.jobs import Ingestion, SilverPipeline
from meridian.plans.registry import ORACLES, long, nth, query, quoted, sql_case, sql_nth
from meridian.sources import fhir, readers, storage
from meridian.streaming.landing import land, windowed_counts

SALT = shapes.SALT


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share; a local session may do without a setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _values(rows: list[tuple], columns: str) -> str:
    said = lambda v: quoted(v) if isinstance(v, str) else f"CAST({v} AS BIGINT)"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(said, r)) + ')' for r in rows)}) AS t({columns})"


@query('SELECT n_nationkey::VARCHAR AS "N_NATIONKEY", n_name AS "N_NAME", n_regionkey::VARCHAR AS "N_REGIONKEY" FROM nation')
def csv_scan(nation):
    """Exported as CSV and read back: headers in capitals, every value as text."""
    folder = scratch(nation.sparkSession, "csv")
    storage.export_csv({"nation": nation}, folder)
    return readers.read_csv(nation.sparkSession, f"{folder}/nation")


@query('SELECT r_regionkey::VARCHAR AS "R_REGIONKEY", r_name AS "R_NAME" FROM region')
def json_scan(region):
    folder = scratch(region.sparkSession, "json")
    region.agg(F.to_json(F.collect_list(F.struct("r_regionkey", "r_name")))).write.text(folder)
    return readers.read_json(region.sparkSession, folder)


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey FROM supplier")
def sqlite_roundtrip(supplier):
    with tempfile.TemporaryDirectory() as folder:
        path = f"{folder}/x.db"
        storage.export_sqlite({"supplier": supplier.select("s_suppkey", "s_name", "s_nationkey")}, path)
        assert storage.sqlite_tables(path) == ["supplier"]
        return storage.read_sqlite(supplier.sparkSession, path, "supplier")


@query("SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, 1 AS month, 'datasus_sih' AS _source_type FROM orders")
def bronze_roundtrip(orders):
    writer = storage.BronzeWriter(scratch(orders.sparkSession, "bronze"))
    rows = orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    path = writer.write(rows, {"source": "datasus", "subsystem": "sih", "source_type": "datasus_sih", "month": 1})["table_path"]
    return writer.format.read(orders.sparkSession, path).drop("_ingested_at", "_source_file")


_MASTER = f"""CASE WHEN length(birth) = 64 AND home IS NOT NULL THEN 'mpi_' || substr(sha256(birth || '_' || home || '_{SALT}'), 1, 16) ELSE 'mpi_' || substr(sha256(patient_id || '_{SALT}'), 1, 16) END"""


@query(f"SELECT encounter_id, patient_id, one.code AS primary_diagnosis_code, {_MASTER} AS patient_master_id FROM {shapes._A}")
def silver_roundtrip(orders):
    """Admissions through the silver pipeline into tables behind a log of commits, and back."""
    spark = orders.sparkSession
    writer = storage.SilverWriter(scratch(spark, "silver"), storage.CommitFormat())
    SilverPipeline(spark, SALT, writer).transform_dataframe(shapes._admissions(orders), "datasus_sih")
    return writer.format.read(spark, f"{writer.path}/fct_encounters").select("encounter_id", "patient_id", "primary_diagnosis_code", "patient_master_id")


def _ingested(orders: DataFrame) -> tuple[dict, str]:
    """Requests through the gate and the validator; those without an id, here the open ones, are rejected."""
    base = scratch(orders.sparkSession, "ingestion")
    rows = shapes._requests(orders.filter("o_orderstatus <> 'P'")).unionByName(shapes._requests(orders.filter("o_orderstatus = 'P'")).withColumn("ID_SOLICITACAO", F.lit(None).cast("string")))
    job = Ingestion("sisreg_regulation", lambda: rows, salt=SALT, bronze=storage.BronzeWriter(f"{base}/bronze"), catalog=storage.DatasetCatalog(f"{base}/catalog"), quarantine=f"{base}/quarantine")
    return job.run({"source": "sisreg", "subsystem": "regulation", "year": 2025, "month": 1}), base


@query(f"""SELECT sha256(o_orderkey || '{SALT}') AS ID_SOLICITACAO, CASE WHEN o_custkey % 3 <> 0 THEN sha256('cns' || o_custkey || '{SALT}') END AS CNS_PACIENTE, sha256('cpf' || o_custkey || '{SALT}') AS CPF_PACIENTE, {sql_nth(["P", "A"], "o_orderkey")} AS STATUS_REGULACAO
 FROM orders WHERE o_orderstatus <> 'P'""")
def ingested_requests(orders):
    out, _ = _ingested(orders)
    return orders.sparkSession.read.parquet(out["bronze"]["table_path"]).select("ID_SOLICITACAO", "CNS_PACIENTE", "CPF_PACIENTE", "STATUS_REGULACAO")


@query(f"SELECT sha256('cpf' || o_custkey || '{SALT}') AS CPF_PACIENTE, {sql_nth(['P', 'A'], 'o_orderkey')} AS STATUS_REGULACAO FROM orders WHERE o_orderstatus = 'P'")
def quarantined_requests(orders):
    _, base = _ingested(orders)
    return orders.sparkSession.read.parquet(f"{base}/quarantine/sisreg_regulation").select("CPF_PACIENTE", "STATUS_REGULACAO")


@query("SELECT 'sisreg_regulation' AS source_type, count(*) AS row_count, true AS pii_anonymized FROM orders WHERE o_orderstatus <> 'P'")
def catalogued(orders):
    """What a job registers in the catalogue."""
    _, base = _ingested(orders)
    rows = storage.DatasetCatalog(f"{base}/catalog").get_datasets_by_source("sisreg_regulation")
    return orders.sparkSession.createDataFrame([(r["source_type"], r["row_count"], r["pii_anonymized"]) for r in rows], "source_type string, row_count long, pii_anonymized boolean")


@query(_values([("ans_data", 7)], "source_type, position"))
def checkpointed(region):
    state = storage.Checkpoints(scratch(region.sparkSession, "state"))
    for at in (3, 7):
        state.save("ans_data", {"at": at})
    return region.sparkSession.createDataFrame([("ans_data", state.load("ans_data")["at"])], "source_type string, position long")


@query(_values([("Patient", 50), ("Organization", 50), *((k, 150) for k in ("Encounter", "Condition", "Observation", "Procedure"))], "resource, n"))
def fhir_generated(region):
    rows = fhir.flatten(fhir.bundles(region.sparkSession, 50, 3))
    return rows.groupBy(F.col("resourceType").alias("resource")).agg(F.count("*").alias("n"))


@query(_values([("plans", 5), ("referrals", 4), ("primary_care", 1)], "batch, n"))
def inline_batches(region):
    found = {"plans": readers.sample_plans, "referrals": readers.sample_referrals, "primary_care": readers.sample_primary_care}
    parts = [make(region.sparkSession).agg(F.count("*").alias("n")).select(F.lit(name).alias("batch"), "n") for name, make in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(" UNION ALL ".join(f"SELECT '{k}' AS subsystem, m AS month, {name} AS name FROM range(1, 13) AS r(m)" for k, name in (("SIH", "'RDAC25' || lpad(m::VARCHAR, 2, '0') || '.dbc'"), ("SIA", "'PAAC25' || lpad(m::VARCHAR, 2, '0') || '.dbc'"), ("CNES", "'STAC25' || lpad(m::VARCHAR, 2, '0') || '.dbc'"), ("SINAN", "'DENGBR25.dbc'"), ("SISAB", "'SISAB_2025_' || lpad(m::VARCHAR, 2, '0') || '.json'"))))
def remote_names(region):
    rows = [(k, m, readers.remote_filename(k, 2025, m)) for k in ("SIH", "SIA", "CNES", "SINAN", "SISAB") for m in range(1, 13)]
    return region.sparkSession.createDataFrame(rows, "subsystem string, month long, name string")


@query(_values([("success_reference", 5)], "status, n"))
def fallback_source(region):
    """A source whose file is not there gives its literal batch, marked as such."""
    spark = region.sparkSession
    df, status = readers.with_fallback(lambda: readers.read_csv(spark, scratch(spark, "nowhere")), lambda: readers.sample_plans(spark))
    return df.agg(F.count("*").alias("n")).select(F.lit(status).alias("status"), "n")


_GATES = (("datasus_cnes", {"CNES": "n_nationkey", "CODUFMUN": "n_name"}, True), ("datasus_cnes", {"CNES": "n_nationkey"}, False), ("datasus_sia", {"PA_CODUNI": "n_name"}, True), ("datasus_sia", {"OTHER": "n_name"}, False), ("unknown", {"OTHER": "n_name"}, True))


@query(" UNION ALL ".join(f"SELECT '{s}' AS source, '{'+'.join(c)}' AS columns, {'count(*)' if ok else '0::BIGINT'} AS valid, {'0::BIGINT' if ok else 'count(*)'} AS rejected FROM nation" for s, c, ok in _GATES))
def column_gates(nation):
    """Sources that must have columns, all of some or one of some; without them every row is rejected."""
    out = None
    for source, columns, _ in _GATES:
        r = validate(nation.select(*[F.col(c).cast("string").alias(name) for name, c in columns.items()]), source)
        n = lambda df, name: df.agg(F.count("*").alias(name))
        row = n(r.valid, "valid").crossJoin(n(r.rejected, "rejected")).select(F.lit(source).alias("source"), F.lit("+".join(columns)).alias("columns"), "valid", "rejected")
        out = row if out is None else out.unionByName(row)
    return out


@query(_values([(s, c) for s, cs in PERSONAL.items() for c in cs if c != "NOME_PAC"], "source, field"))
def personal_fields(region):
    """What the manifest finds in each source's columns; a name that no source has here is left out."""
    rows = [(s, c) for s, cs in privacy.load_manifest().items() for c in privacy.personal_columns(s, [x for x in cs if x != "NOME_PAC"])]
    return region.sparkSession.createDataFrame(rows, "source string, field string")


@query(ORACLES["event_windows"])
def stream_windows(events):
    """The counts of event_windows by a stream that reads the events as files."""
    spark, base = events.sparkSession, scratch(events.sparkSession, "stream")
    events.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{base}/in").withColumn("value", F.round("value", 2).cast("decimal(18,2)"))
    # a watermark needs instants: local times are taken as those of UTC, whatever the session's zone
    instant = F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    counts = windowed_counts(stream.withColumn("ts", instant)).withColumn("total", F.col("total").cast("double"))
    counts = counts.withColumn("window_start", F.from_utc_timestamp("window_start", F.current_timezone()).cast("timestamp_ntz"))
    counts.writeStream.outputMode("complete").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{base}/out")).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{base}/out")


@query(f"SELECT sha256(o_orderkey || '{SALT}') AS NU_NOTIFIC, strftime(o_orderdate, '%Y%m%d') AS DT_NOTIFIC, (120000 + o_custkey % 60)::VARCHAR AS ID_MUNICIP FROM orders")
def landed_stream(orders):
    """Notifications that come as CSV files into a folder, hashed and validated on their way to a table."""
    spark, base = orders.sparkSession, scratch(orders.sparkSession, "landing")
    rows = orders.select(F.col("o_orderkey").alias("NU_NOTIFIC"), F.date_format("o_orderdate", "yyyyMMdd").alias("DT_NOTIFIC"), (F.col("o_custkey") % 60 + 120000).alias("ID_MUNICIP"))
    rows.write.option("header", True).csv(f"{base}/in")
    land(spark, f"{base}/in", "NU_NOTIFIC string, DT_NOTIFIC string, ID_MUNICIP string", "datasus_sinan", f"{base}/out", f"{base}/state", SALT).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("NU_NOTIFIC", "DT_NOTIFIC", "ID_MUNICIP")


@query("SELECT 'org_cnes_' || lpad(s_suppkey::VARCHAR, 7, '0') AS organization_id, 'org_cnes_' || lpad(s_suppkey::VARCHAR, 7, '0') AS organization_master_id FROM supplier")
def facility_index(supplier):
    rows = mapping.map_facilities(supplier.select(F.col("s_suppkey").cast("string").alias("CNES")))
    return identity.resolve(rows, SALT).dim_organizations.select("organization_id", "organization_master_id")


@query(f"SELECT 'r' || o_orderkey AS referral_id, 'mpi_' || substr(sha256(CASE WHEN c_nationkey <> 3 THEN sha256(c_name) || '_' || c_nationkey ELSE c_custkey::VARCHAR END || '_{SALT}'), 1, 16) AS patient_master_id FROM orders JOIN customer ON o_custkey = c_custkey")
def referral_enrichment(orders, customer):
    """Referrals that know a patient get the patient's master id."""
    patients = customer.select(F.col("c_custkey").cast("string").alias("patient_id"), F.when(F.col("c_nationkey") != 3, F.sha2("c_name", 256)).alias("birth_date_hash"), F.col("c_nationkey").cast("string").alias("municipality_code"))
    rows = orders.join(customer.select("c_custkey"), orders.o_custkey == customer.c_custkey, "left_semi").select(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("referral_id"), F.col("o_custkey").cast("string").alias("patient_id"))
    return identity.resolve(mapping.CanonicalDataset(dim_patients=patients, fct_referrals=rows), SALT).fct_referrals.select("referral_id", "patient_master_id")


@query("""SELECT 'dim_patients' AS name, count(*) AS n FROM customer UNION ALL SELECT 'dim_organizations', count(*) FROM supplier UNION ALL SELECT 'fct_encounters', count(*) FROM orders UNION ALL SELECT 'fct_conditions', count(*) FROM orders
 UNION ALL SELECT 'fct_procedures', count(*) FROM orders UNION ALL SELECT 'dim_health_plans', 0 UNION ALL SELECT 'fct_referrals', 0""")
def canonical_summary(customer, supplier, orders):
    return customer.sparkSession.createDataFrame(list(shapes._fhir(customer, supplier, orders).summary().items()), "name string, n long")


@query("SELECT c_mktsegment AS segment, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS n_rows FROM customer GROUP BY 1")
def inspection(customer):
    told = storage.inspect(customer, by="c_mktsegment")
    return customer.sparkSession.createDataFrame([(k, n, told["rows"]) for k, n in told["distribution"].items()], "segment string, n long, n_rows long")


_CODES = [*list(tables.MUNICIPALITIES)[:8], "1200401", "355030", "999999", "41.0", None]
_FULL = "lpad(replace(code, '.0', ''), greatest(6, length(replace(code, '.0', '')))::INT, '0')"


@query(f"""SELECT p_partkey, coalesce({sql_case("substr(c, 1, 6)", tables.MUNICIPALITIES)}, 'Município de ' || {sql_case("substr(c, 1, 2)", tables.STATE_NAMES)} || ' [' || c || ']', 'Município [' || c || ']') AS place
 FROM (SELECT p_partkey, {_FULL} AS c FROM (SELECT p_partkey, {sql_nth(_CODES, "p_partkey")} AS code FROM part))""")
def full_places(part):
    return part.select("p_partkey", terminology.full_municipality_label(nth(_CODES, F.col("p_partkey"))).alias("place"))


@query("SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS CD_OPERADORA, CAST(n_nationkey AS BIGINT) AS ordinal FROM nation")
def ensured_columns(nation):
    """A column that is missing comes as nulls; one that is there stays."""
    from meridian.operators.relational import ensure_columns

    return ensure_columns(nation.select("n_nationkey", "n_name", long(F.col("n_nationkey")).alias("ordinal")), {"CD_OPERADORA": "string", "n_name": "string"})
