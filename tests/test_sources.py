from __future__ import annotations

import json
import struct

import pytest
from pyspark.sql import functions as F

from meridian.plans.jobs import CircuitBreakerOpen, Ingestion, SilverPipeline, merge
from meridian.operators import mapping
from meridian.sources import dbf, fhir, readers, storage
from meridian.sources import implode as codec
from meridian.streaming import landing


def test_file_names():
    assert readers.remote_filename("SIH", 2025, 1) == "RDAC2501.dbc"
    assert readers.remote_filename("SIA", 2026, 1) == "PAAC2601.dbc"
    assert readers.remote_filename("CNES", 2025, 12, "SP") == "STSP2512.dbc"
    assert readers.remote_filename("SINAN", 2025) == "DENGBR25.dbc"
    assert readers.remote_filename("SISAB", 2025, 3) == "SISAB_2025_03.json"
    with pytest.raises(ValueError):
        readers.remote_filename("X", 2025)


class Client:
    def __init__(self, have):
        self.have, self.asked = have, []

    def retrbinary(self, command, write):
        self.asked.append(command)
        if command.removeprefix("RETR ") not in self.have:
            raise OSError("550")
        write(b"data")

    def close(self):
        pass


def test_fetch_tries_directories(tmp_path):
    c = Client({"/b/x"})
    assert readers.fetch_first("h", ("/a/", "/b/"), "x", str(tmp_path), lambda h, t: c).endswith("/x")
    assert c.asked == ["RETR /a/x", "RETR /b/x"]
    with pytest.raises(RuntimeError):
        readers.fetch_first("h", ("/a/",), "x", str(tmp_path), lambda h, t: c)


def test_csv_and_json_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text(" code ,n\n007,1\n")
    assert readers.read_records(spark, str(tmp_path / "a.csv")).collect()[0].asDict() == {"CODE": "007", "N": "1"}
    (tmp_path / "a.json").write_text(json.dumps([{"code": "007", "n": 1}]))
    assert readers.read_records(spark, str(tmp_path / "a.json")).first().N == "1"


def test_fallback(spark):
    df, status = readers.with_fallback(lambda: spark.read.parquet("/nowhere"), lambda: readers.sample_plans(spark))
    assert status == "success_reference" and df.count() == 5
    assert readers.with_fallback(lambda: readers.sample_plans(spark), lambda: None)[1] == "success"


def dbf_bytes(rows):
    fields = [("CODE", 5), ("NAME", 8)]
    size = 1 + sum(n for _, n in fields)
    head = struct.pack("<B3BIHH20x", 3, 25, 1, 1, len(rows), 32 + 32 * len(fields) + 1, size)
    for name, n in fields:
        head += name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([n]) + b"\0" * 15
    body = b"".join((b"*" if gone else b" ") + a.encode("latin1").ljust(5) + b.encode("latin1").ljust(8) for a, b, gone in rows)
    return head + b"\r" + body + b"\x1a"


def decode_dbc(data: bytes) -> bytes:
    return data[::-1]


def test_dbf(spark, tmp_path):
    data = dbf_bytes([("007", "São", False), ("x", "gone", True), ("", "b", False)])
    (tmp_path / "a.dbf").write_bytes(data)
    spark.dataSource.register(dbf.DbfSource)
    rows = spark.read.format("dbf").load(str(tmp_path / "a.dbf")).collect()
    assert [(r.CODE, r.NAME) for r in rows] == [("007", "São"), (None, "b")]
    (tmp_path / "a.dbc").write_bytes(data[::-1])
    with pytest.raises(ValueError):
        dbf.contents(str(tmp_path / "a.dbc"))
    assert dbf.contents(str(tmp_path / "a.dbc"), "test_sources:decode_dbc") == data


def implode(data: bytes, coded: bool, window: int = 6) -> bytes:
    """A plain encoder: the longest earlier copy, else a literal."""
    out: list[tuple[int, int]] = []
    literal, length, distance = map(codec.codes, (codec._LITERALS, codec._LENGTHS, codec._DISTANCES))
    at = 0
    while at < len(data):
        size, back = max(((n, b) for b in range(1, min(at, 200) + 1) for n in (next((k for k in range(min(40, len(data) - at)) if data[at + k] != data[at + k - b]), min(40, len(data) - at)),)), default=(0, 0))
        if size >= 2:
            which = next(k for k in range(16) if codec._BASE[k] <= size < codec._BASE[k] + (1 << codec._EXTRA[k]))
            low = 2 if size == 2 else window
            out += [(1, 1), length[which], (size - codec._BASE[which], codec._EXTRA[which]), distance[(back - 1) >> low], ((back - 1) & ((1 << low) - 1), low)]
            at += size
        else:
            out += [(0, 1), literal[data[at]] if coded else (data[at], 8)]
            at += 1
    out += [(1, 1), length[15], (255, 8)]
    bits, n = 0, 0
    for x, k in out:
        bits, n = bits | x << n, n + k
    return bytes([coded, window]) + bits.to_bytes((n + 7) // 8, "little")


def test_implode():
    assert codec.explode(bytes.fromhex("00048224258f807f")) == b"AIAIAIAIAIAIA"
    for packed in (codec._LITERALS, codec._LENGTHS, codec._DISTANCES):  # each is a whole prefix code
        assert sum(2.0**-n for n in codec.lengths(packed)) == 1
    every = bytes(range(256))
    for data in (b"", b"a", b"aaaaaaaaaaaa", every, every * 2 + b"tail" * 30, "não é nada, não é".encode("latin1") * 9):
        for coded in (False, True):
            for window in (4, 5, 6):
                assert codec.explode(implode(data, coded, window)) == data
    with pytest.raises(ValueError):
        codec.explode(implode(b"some text", True)[:6])


def test_dbc(spark, tmp_path):
    data = dbf_bytes([(str(i), "name", i % 4 == 0) for i in range(40)])
    size = 32 + 32 * 2 + 1
    (tmp_path / "a.dbc").write_bytes(data[:size] + b"\0\0\0\0" + implode(data[size:], True))
    spark.dataSource.register(dbf.DbfSource)
    df = spark.read.format("dbf").load(str(tmp_path / "a.dbc"))
    assert df.columns == ["CODE", "NAME"] and sorted(int(r.CODE) for r in df.collect()) == [i for i in range(40) if i % 4]


def test_fhir_generator(spark):
    b = fhir.bundles(spark, 5, 3, seed=1)
    rows = fhir.flatten(b)
    assert rows.count() == 5 * (2 + 4 * 3)
    kinds = {r.resourceType: r["count"] for r in rows.groupBy("resourceType").count().collect()}
    assert kinds == {"Patient": 5, "Organization": 5, "Encounter": 15, "Condition": 15, "Observation": 15, "Procedure": 15}
    p = rows.filter("resourceType = 'Patient'").first()
    assert len(p.cpf) == 11 and p.name_family and p.name_given and p.subject_ref is None
    assert sorted(map(str, b.collect())) == sorted(map(str, fhir.bundles(spark, 5, 3, seed=1).repartition(3).collect()))
    ds = mapping.map_fhir(rows, "f")
    assert ds.summary()["fct_conditions"] == 15


def bronze_rows(spark):
    return spark.createDataFrame([("p1", 1), ("p2", 2), ("p3", 3)], "patient_id string, value int")


META = {"source": "datasus", "subsystem": "sih", "source_type": "datasus_sih", "source_file": "f.dbc", "year": 2025, "month": 1}


def test_bronze(spark, tmp_path):
    w = storage.BronzeWriter(str(tmp_path))
    stats = w.write(bronze_rows(spark), META)
    assert stats["rows_written"] == 3 and stats["table_path"].endswith("datasus/sih") and stats["duration_seconds"] >= 0
    w.write(bronze_rows(spark), META)
    t = spark.read.parquet(stats["table_path"])
    assert t.count() == 6 and {"_ingested_at", "_source_type", "_source_file", "year", "month"} <= set(t.columns)
    assert (tmp_path / "datasus/sih/year=2025/month=1").is_dir()
    assert w.write(bronze_rows(spark).limit(0), META)["rows_written"] == 0
    empty = w.write(bronze_rows(spark).limit(0), META | {"subsystem": "cnes"})
    assert empty["rows_written"] == 0 and not w.format.exists(spark, empty["table_path"]) and not (tmp_path / "datasus/cnes").exists()
    w.write(bronze_rows(spark), META, idempotent=True)
    assert spark.read.parquet(stats["table_path"]).count() == 3


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_commit_format(spark, tmp_path, scheme):
    fmt, path = storage.CommitFormat(), f"{scheme}{tmp_path}/t"
    w = storage.BronzeWriter(f"{scheme}{tmp_path}", fmt)
    assert not fmt.exists(spark, path)
    where = w.write(bronze_rows(spark), META)["table_path"]
    w.write(bronze_rows(spark).withColumn("more", F.lit("x")), META | {"month": 2})
    t = fmt.read(spark, where)
    assert t.count() == 6 and t.filter("month = 2 and more = 'x'").count() == 3 and fmt.read(spark, where, 0).count() == 3
    broken = bronze_rows(spark).withColumn("value", F.when(F.col("value") == 2, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="stop"):
        w.write(broken, META)
    assert fmt.read(spark, where).count() == 6
    log = storage.JsonFolder(f"{where}/_commits", spark)
    assert log.names() == ["0000000000", "0000000001"] and not log.create("0000000001", {}) and log.read("0000000001")["folder"]
    w.write(bronze_rows(spark).limit(1), META, idempotent=True)
    assert fmt.read(spark, where).count() == 1 and fmt.read(spark, where, 1).count() == 6
    p = SilverPipeline(spark, "s", storage.SilverWriter(f"{scheme}{tmp_path}/s", fmt))
    p.transform_dataframe(readers.sample_plans(spark), "ans_data")
    p.transform_dataframe(readers.sample_plans(spark), "ans_data")
    assert fmt.read(spark, f"{scheme}{tmp_path}/s/dim_health_plans").count() == 10
    assert w.write(bronze_rows(spark).limit(0), META | {"subsystem": "none"})["rows_written"] == 0 and not fmt.exists(spark, f"{scheme}{tmp_path}/datasus/none")


def test_silver(spark, tmp_path):
    ds = mapping.CanonicalDataset(dim_patients=spark.createDataFrame([("m", "male")], "patient_master_id string, gender string"), fct_conditions=spark.createDataFrame([], "condition_id string"))
    w = storage.SilverWriter(str(tmp_path))
    got = w.write_canonical_dataset(ds)
    assert got["dim_patients"] == {"status": "success", "rows_written": 1}
    assert got["fct_conditions"]["status"] == got["dim_health_plans"]["status"] == "skipped_empty"
    w.write_table(spark.createDataFrame([("n", "AC")], "patient_master_id string, uf string"), "dim_patients")
    t = w.format.read(spark, str(tmp_path / "dim_patients"))
    assert t.count() == 2 and set(t.columns) == {"patient_master_id", "gender", "uf"}


def test_catalog_and_checkpoint(tmp_path):
    c = storage.DatasetCatalog(str(tmp_path / "c"))
    a = c.register_dataset("x", "/p", 3, "fp")
    c.register_dataset("y", "/q", 0, "fp", extra_metadata={"k": 1})
    assert c.get_dataset(a)["row_count"] == 3 and c.get_dataset("none") is None
    assert len(c.list_datasets()) == 2 and len(c.get_datasets_by_source("y")) == 1
    k = storage.Checkpoints(str(tmp_path / "s"))
    assert k.load("x") is None
    k.save("x", {"at": 1})
    assert k.load("x") == {"at": 1}


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", None, True)], "s string, n int, f boolean")
    path = str(tmp_path / "x.db")
    assert storage.export_sqlite({"t": df}, path) == {"t": 2}
    assert storage.export_sqlite({"t": df}, path) == {"t": 2}
    assert storage.sqlite_tables(path) == ["t"]
    assert sorted(tuple(r) for r in storage.read_sqlite(spark, path, "t").fillna("").collect()) == [("a", "1", ""), ("b", "", "true")]
    storage.export_csv({"t": df}, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv/t"), header=True).count() == 2
    assert storage.inspect(df, by="s", hashed="s") == {"columns": ["s", "n", "f"], "rows": 2, "hashed_share": 0.0, "distribution": {"a": 1, "b": 1}}


def test_retry_and_breaker(spark):
    waits, calls = [], []

    def fails():
        calls.append(1)
        raise OSError("down")

    job = Ingestion("x", fails, max_retries=2, retry_backoff=5)
    with pytest.raises(OSError):
        job.run(sleep=waits.append)
    assert (len(calls), waits, job.failures) == (2, [5], 2)
    with pytest.raises(CircuitBreakerOpen):
        job.run(sleep=waits.append)
    assert len(calls) == 2


def test_ingestion_end_to_end(spark, tmp_path):
    bronze, catalog = storage.BronzeWriter(str(tmp_path / "b")), storage.DatasetCatalog(str(tmp_path / "c"))
    job = Ingestion("sisreg_regulation", lambda: readers.sample_referrals(spark), salt="s", bronze=bronze, catalog=catalog, quarantine=str(tmp_path / "q"))
    out = job.run({"source": "sisreg", "subsystem": "regulation"})
    assert out["bronze"]["rows_written"] == 4 and catalog.get_dataset(out["dataset_id"])["pii_anonymized"]
    assert len(spark.read.parquet(out["bronze"]["table_path"]).first().CPF_PACIENTE) == 64
    silver = storage.SilverWriter(str(tmp_path / "s"))
    p = SilverPipeline(spark, "s", silver, catalog)
    got = p.transform_bronze_table(out["bronze"]["table_path"], "sisreg_regulation")
    assert got["fct_referrals"]["rows_written"] == 4
    assert p.transform_bronze_table(str(tmp_path / "none"), "sih") == {"skipped": True}


def test_retry_repeats_nothing_that_was_written(spark, tmp_path):
    catalog = storage.DatasetCatalog(str(tmp_path / "c"))
    register, fails = catalog.register_dataset, [1, 1]

    def sometimes(*a, **k):
        if fails:
            fails.pop()
            raise OSError("catalogue is down")
        return register(*a, **k)

    catalog.register_dataset = sometimes
    fetched = []
    job = Ingestion("sisreg_regulation", lambda: fetched.append(1) or readers.sample_referrals(spark), salt="s", bronze=storage.BronzeWriter(str(tmp_path / "b")), catalog=catalog, quarantine=str(tmp_path / "q"))
    out = job.run({"source": "sisreg", "subsystem": "regulation"}, sleep=lambda s: None)
    assert spark.read.parquet(out["bronze"]["table_path"]).count() == 4 and len(fetched) == 1
    assert [r["dataset_id"] for r in catalog.list_datasets()] == [out["dataset_id"]] and job.failures == 0
    broken = storage.BronzeWriter(str(tmp_path / "b2"))
    write, tries = broken.write, [1]

    def second(*a, **k):
        if tries:
            tries.pop()
            raise OSError("bronze is down")
        return write(*a, **k)

    broken.write = second
    rows = spark.createDataFrame([("A", None), ("Patient", "p")], "resourceType string, id string")
    job = Ingestion("fhir_synthetic", lambda: rows, bronze=broken, quarantine=str(tmp_path / "q2"))
    out = job.run({"source": "fhir", "subsystem": "r4"}, sleep=lambda s: None)
    assert out["bronze"]["rows_written"] == 1 and spark.read.parquet(str(tmp_path / "q2/fhir_synthetic")).count() == 1


def test_empty_month_is_skipped(spark, tmp_path):
    bronze = storage.BronzeWriter(str(tmp_path / "b"))
    path = bronze.write(bronze_rows(spark).limit(0), META)["table_path"]
    assert SilverPipeline(spark, "s", storage.SilverWriter(str(tmp_path / "s"))).transform_bronze_table(path, "datasus_sih") == {"skipped": True}


def test_silver_tables_come_from_one_reading(spark, tmp_path):
    """Keys that each reading would make anew are the same in all tables."""
    rows = spark.range(20).select(F.expr("uuid()").alias("N_AIH"), F.lit("A90").alias("DIAG_PRINC"), F.lit(None).alias("DIAG_SECUN")).repartition(3)
    SilverPipeline(spark, "s", storage.SilverWriter(str(tmp_path / "s"))).transform_dataframe(rows, "datasus_sih")
    ids = lambda t: {r.encounter_id for r in spark.read.parquet(str(tmp_path / "s" / t)).collect()}
    assert ids("fct_encounters") == ids("fct_conditions") and len(ids("fct_encounters")) == 20
    assert not list((tmp_path / "s/_base").glob("*"))


def test_catalog_by_hadoop_file_system(spark, tmp_path):
    c = storage.DatasetCatalog(f"file://{tmp_path}/c")
    assert c.list_datasets() == []
    a = c.register_dataset("x", "/p", 3, "fp")
    assert c.get_dataset(a)["row_count"] == 3 and c.get_dataset("none") is None and (tmp_path / f"c/{a}.json").exists()
    k = storage.Checkpoints(f"file://{tmp_path}/s")
    for at in (1, 2):
        k.save("x", {"at": at})
    assert k.load("x") == {"at": 2} and k.load("y") is None


def test_dbf_in_parts(spark, tmp_path):
    data = dbf_bytes([(str(i), "x", i % 5 == 0) for i in range(23)])
    (tmp_path / "a.dbf").write_bytes(data)
    spark.dataSource.register(dbf.DbfSource)
    df = spark.read.format("dbf").option("rowsPerPartition", 4).load(f"{tmp_path}/a.dbf")
    assert df.rdd.getNumPartitions() == 6
    assert sorted(int(r[0]) for r in df.collect()) == [i for i in range(23) if i % 5]
    assert spark.read.format("dbf").load(f"file://{tmp_path}/a.dbf").count() == 18


def test_notebook(tmp_path):
    import json

    from meridian.plans import notebook

    n = notebook.write_notebook(str(tmp_path / "n.ipynb"), "/lake/silver")
    made = json.loads((tmp_path / "n.ipynb").read_text())
    assert made["nbformat"] == 4 and len(made["cells"]) == n == 2 + 2 * len(notebook.REPORTS)
    for cell in made["cells"]:
        if cell["cell_type"] == "code":
            compile("".join(cell["source"]), "cell", "exec")


def test_windows_of_a_stream(spark, tmp_path):
    events = spark.createDataFrame([("a", 1, "2025-01-01 10:00:00", 1.0), ("a", 1, "2025-01-01 10:10:00", 2.0), ("b", 1, "2025-01-01 12:00:00", 4.0)], "event_type string, user_id int, at string, value double").withColumn("ts", F.to_timestamp("at"))
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    for name, make in (("tumbling", landing.windowed_counts), ("sliding", lambda e: landing.windowed_counts(e, "1 hour", slide="30 minutes")), ("sessions", landing.sessions)):
        make(stream).writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        got = sorted(map(repr, spark.table(name).collect()))
        assert got and got == sorted(map(repr, make(events).collect())), name
    assert sorted(r.n for r in spark.table("sessions").collect()) == [1, 2] and spark.table("sliding").count() == 4


def test_merge(spark):
    a = mapping.map_health_plans(readers.sample_plans(spark))
    assert merge(a, a).summary()["dim_health_plans"] == 10


def test_landing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("NU_NOTIFIC,DT_NOTIFIC,ID_MUNICIP\n1,20250101,120040\n")
    go = lambda: landing.land(spark, str(tmp_path / "in"), "NU_NOTIFIC string, DT_NOTIFIC string, ID_MUNICIP string", "datasus_sinan", str(tmp_path / "out"), str(tmp_path / "cp"), "s").awaitTermination()
    go()
    (tmp_path / "in/b.csv").write_text("NU_NOTIFIC,DT_NOTIFIC,ID_MUNICIP\n2,20250102,120040\n")
    go()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 2 and all(len(r.NU_NOTIFIC) == 64 for r in rows)


def test_labelled_export(spark, tmp_path):
    from meridian.plans.export import export, labelled

    sia = spark.createDataFrame([("0303010010", "2000121", "120040")], "PA_PROC_ID string, PA_CODUNI string, PA_UFMUN string")
    row = labelled(sia, "sia_ambulatorial").first()
    assert (row.procedure_name, row.hospital_name, row.municipality_name) == ("Tratamento Clínico de Dengue", "Hospital Municipal de Feijó", "Rio Branco (Capital)")
    assert labelled(sia.drop("PA_CODUNI"), "sia_ambulatorial").columns == ["PA_PROC_ID", "PA_UFMUN", "procedure_name", "municipality_name"]
    sinan = spark.createDataFrame([("1", "120020")], "NU_NOTIFIC string, ID_MUNICIP string")
    got = export({"sia_ambulatorial": sia, "sinan_agravos_dengue": sinan, "fct_referrals": None}, str(tmp_path / "csv"), str(tmp_path / "x.db"))
    assert got == {"sia_ambulatorial": 1, "sinan_agravos_dengue": 1}
    assert storage.read_sqlite(spark, str(tmp_path / "x.db"), "sinan_agravos_dengue").first().disease_name == "Dengue / Arbovirose"
    assert spark.read.csv(str(tmp_path / "csv/sinan_agravos_dengue"), header=True).count() == 1
