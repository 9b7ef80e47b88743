from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from meridian.functions import terminology as term
from meridian.functions import text


def values(spark, rows, make, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r.v for r in df.select("i", make(F.col("c")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("code, want, chapter", [("a090", "A09.0", "I"), ("I10", "I10", "IX"), (" o80.0 ", "O80.0", "XV"), ("S12", "S12", "XIX")])
def test_diagnosis(spark, code, want, chapter):
    d = values(spark, [code], term.diagnosis)[0]
    assert (d.code, d.valid, d.chapter) == (want, True, chapter)


def test_diagnosis_odd_codes(spark):
    short, wrong, zeros, *nothing = values(spark, ["1", "123", "0000", "", None, "nan", " none "], term.diagnosis)
    assert (short.valid, short.reason) == (False, "Code too short")
    assert (wrong.code, wrong.reason) == ("123", "Invalid CID-10 format")
    assert zeros.code == "0000" and not zeros.valid and zeros.chapter is None
    assert nothing == [None] * 4


@pytest.mark.parametrize("code", ["D49", "D90", "E91", "H96", "K94", "P97", "T99", "U07", "V00", "Y99"])
def test_chapter_gaps(spark, code):
    d = values(spark, [code], term.diagnosis)[0]
    assert (d.valid, d.chapter, d.chapter_description) == (True, "UNKNOWN", "Não identificado")


def test_procedure(spark):
    full, nine, short, none = values(spark, ["0301010010", "301010010", "123", None], term.procedure)
    assert (full.formatted, full.group_code, full.group_description) == ("03.01.01.001-0", "03", "Procedimentos clínicos")
    assert nine.code == "0301010010"
    assert (short.valid, short.code, short.reason) == (False, "123", "Expected 10 digits, got 3")
    assert none is None


def test_municipality(spark):
    seven, six, bad, other = values(spark, ["2304400", "355030", "12", "990000"], term.municipality)
    assert (seven.code, seven.state, seven.full_code) == ("230440", "CE", "2304400")
    assert (six.code, six.state) == ("355030", "SP")
    assert not bad.valid and bad.code == "12"
    assert other.state == "BR"


def test_labels(spark):
    assert values(spark, ["I21.9", "I21.7", "Q99", None], term.diagnosis_label) == ["Infarto Agudo do Miocárdio não especificado (IAM)", "Infarto Agudo do Miocárdio", "Diagnóstico [Q99]", "Diagnóstico []"]
    assert values(spark, ["Q99"], lambda c: term.diagnosis_label(c, F.lit("XVII"))) == ["Diagnóstico [Q99] (XVII)"]
    assert values(spark, ["03.03.01.001-0", "1"], term.procedure_label) == ["Tratamento Clínico de Dengue", "Procedimento SUS [1]"]
    assert values(spark, ["1200401", "999999"], term.municipality_label) == ["Rio Branco (Capital)", "Município IBGE [999999]"]
    assert values(spark, ["org_cnes_2000121", "7"], term.hospital_label) == ["Hospital Municipal de Feijó", "Hospital CNES [7]"]
    assert values(spark, ["120040.0", "110001", "999999", "5"], term.full_municipality_label) == ["Rio Branco (Capital)", "Município de Rondônia [110001]", "Município [999999]", "Município [000005]"]


def test_recodes(spark):
    assert values(spark, ["1", "masc", "F", "3", "9", None], term.gender) == ["male", "male", "female", "female", "other", "unknown"]
    assert values(spark, ["02", "3", "1", "x", None], term.encounter_class) == ["EMER", "EMER", "AMB", "IMP", "IMP"]


def test_compact_date(spark):
    assert values(spark, ["20250131", "20251399", "20250131.0", "2025-01-31", "0", "00000000", "nan", "", None], term.compact_date) == ["2025-01-31", "2025-13-99", "2025-01-31", "2025-01-31", None, None, None, None, None]


def test_days_between(spark):
    df = spark.createDataFrame([("2025-01-04 14:15:00", "2025-01-02 08:30:00"), (None, "2025-01-02 08:30:00"), ("2025-01-01 00:00:00", "2025-01-02 12:00:00"), ("junk", "2025-01-01")], "a string, b string")
    assert [r.v for r in df.select(term.days_between(F.col("a"), F.col("b")).alias("v")).collect()] == [2.24, 0.0, -1.5, 0.0]


def test_hash(spark):
    want = hashlib.sha256("José Asalt".encode()).hexdigest()
    got = values(spark, ["José A", " \tJosé A\n", "", "  ", None], lambda c: text.salted_hash(c, "salt"))
    assert got == [want, want, None, None, None]
    assert values(spark, [want, "abc", None], text.is_hash) == [True, False, False]


def test_numbers(spark):
    assert values(spark, ["1,5", " 2.25 ", "x", None], text.decimal_number) == [1.5, 2.25, None, None]
    assert values(spark, ["3", "4.9", "", "x"], text.whole_number) == [3, 4, None, None]
    assert values(spark, ["12345678", "12"], lambda c: text.zero_pad(c, 7)) == ["12345678", "0000012"]


def test_differs(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "a string, b string")
    assert [r.v for r in df.select(text.differs(F.col("a"), F.col("b")).alias("v")).collect()] == [False, True, True, True]


def test_coverage(spark):
    df = spark.createDataFrame([(48500, "120040"), (300, "999999")], "n int, c string")
    assert [r.v for r in df.select(term.coverage_ratio(F.col("n"), F.col("c")).alias("v")).collect()] == [11.56, 1.0]
