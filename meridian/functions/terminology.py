"""Normalisation and labels of diagnosis, procedure and municipality codes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meridian.functions import tables as t
from meridian.functions.text import digits, filled, let, lookup, strip, zero_pad

_NOTHING = ("NAN", "NONE", "NULL")


def chapter_of(category: Column) -> Column:
    """struct(chapter, description) of a three-character category; the ranges are compared as text."""
    out = None
    for name, (first, last, label) in t.CHAPTERS.items():
        made = F.struct(F.lit(name).alias("chapter"), F.lit(label).alias("description"))
        hit = category.between(first, last)
        out = F.when(hit, made) if out is None else out.when(hit, made)
    return out.otherwise(F.struct(F.lit("UNKNOWN").alias("chapter"), F.lit(t.NO_CHAPTER).alias("description")))


def concept(system: str, code: Column, display: Column | None = None) -> Column:
    """A CodeableConcept; without a display the code is shown."""
    shown = F.coalesce(filled(display), code) if display is not None else code
    coding = F.struct(F.lit(system).alias("system"), code.alias("code"), shown.alias("display"))
    return F.struct(F.array(coding).alias("coding"), shown.alias("text"))


def diagnosis(code: Column) -> Column:
    """struct(code, valid, reason, category, subcategory, chapter, chapter_description); null for blank codes."""
    return let(F.upper(strip(code)), lambda raw: let(F.regexp_replace(raw, "[^A-Z0-9]", ""), lambda bare: let(F.substring(bare, 1, 3), lambda category: _diagnosis(raw, bare, category))))


def _diagnosis(raw: Column, bare: Column, category: Column) -> Column:
    rest = F.substring(bare, 4, 100)
    short, good = F.length(bare) < 3, category.rlike("^[A-Z][0-9]{2}$")
    valid = ~short & good
    chapter = chapter_of(category)
    made = F.struct(
        F.when(~valid, raw).when(rest == "", category).otherwise(F.concat_ws(".", category, rest)).alias("code"),
        valid.alias("valid"),
        F.when(short, F.lit("Code too short")).when(~good, F.lit("Invalid CID-10 format")).alias("reason"),
        F.when(valid, category).alias("category"),
        F.when(valid & (rest != ""), rest).alias("subcategory"),
        F.when(valid, chapter["chapter"]).alias("chapter"),
        F.when(valid, chapter["description"]).alias("chapter_description"),
    )
    return F.when(raw.isNotNull() & (raw != "") & ~raw.isin(*_NOTHING), made)


def procedure(code: Column) -> Column:
    """struct(code, valid, reason, formatted, group_code, group_description); null for blank codes."""
    raw = filled(code)
    found = digits(raw)
    ten = F.when(F.length(found) == 9, F.concat(F.lit("0"), found)).otherwise(found)
    valid = F.length(ten) == 10
    part = lambda a, n: F.substring(ten, a, n)
    shaped = F.concat(part(1, 2), F.lit("."), part(3, 2), F.lit("."), part(5, 2), F.lit("."), part(7, 3), F.lit("-"), part(10, 1))
    made = F.struct(
        F.when(valid, ten).otherwise(raw).alias("code"),
        valid.alias("valid"),
        F.when(~valid, F.concat(F.lit("Expected 10 digits, got "), F.length(ten).cast("string"))).alias("reason"),
        F.when(valid, shaped).alias("formatted"),
        F.when(valid, part(1, 2)).alias("group_code"),
        F.when(valid, lookup(part(1, 2), t.PROCEDURE_GROUPS, F.lit(t.NO_GROUP))).alias("group_description"),
    )
    return F.when(raw.isNotNull() & ~F.upper(raw).isin(*_NOTHING), made)


def municipality(code: Column) -> Column:
    """struct(code, valid, reason, state, full_code); null for blank codes."""
    raw = filled(code)
    found = digits(raw)
    valid = F.length(found).isin(6, 7)
    made = F.struct(
        F.when(valid, F.substring(found, 1, 6)).otherwise(raw).alias("code"),
        valid.alias("valid"),
        F.when(~valid, F.concat(F.lit("Expected 6 or 7 digits, got "), F.length(found).cast("string"))).alias("reason"),
        F.when(valid, lookup(F.substring(found, 1, 2), t.STATES, F.lit("BR"))).alias("state"),
        F.when(F.length(found) == 7, found).alias("full_code"),
    )
    return F.when(raw.isNotNull() & ~F.upper(raw).isin(*_NOTHING), made)


def diagnosis_label(code: Column, chapter: Column | None = None) -> Column:
    """The code's label, else that of what stands before the point, else the code itself with its chapter."""
    c = F.upper(F.coalesce(strip(code), F.lit("")))
    bare = F.concat(F.lit("Diagnóstico ["), c, F.lit("]"))
    named = bare if chapter is None else F.when(F.coalesce(chapter, F.lit("")) != "", F.concat(bare, F.lit(" ("), chapter, F.lit(")"))).otherwise(bare)
    return F.coalesce(lookup(c, t.DIAGNOSES), lookup(F.substring_index(c, ".", 1), t.DIAGNOSES), named)


def procedure_label(code: Column) -> Column:
    c = F.translate(F.coalesce(strip(code), F.lit("")), ".-", "")
    return lookup(c, t.PROCEDURES, F.concat(F.lit("Procedimento SUS ["), c, F.lit("]")))


def municipality_label(code: Column) -> Column:
    c = F.substring(F.coalesce(strip(code), F.lit("")), 1, 6)
    return lookup(c, t.MUNICIPALITIES, F.concat(F.lit("Município IBGE ["), c, F.lit("]")))


def hospital_label(code: Column) -> Column:
    c = F.replace(F.coalesce(strip(code), F.lit("")), F.lit("org_cnes_"), F.lit(""))
    return lookup(c, t.HOSPITALS, F.concat(F.lit("Hospital CNES ["), c, F.lit("]")))


def full_municipality_label(code: Column) -> Column:
    """By six or seven digits, then by state, then the bare code."""
    c = zero_pad(F.replace(strip(code), F.lit(".0"), F.lit("")), 6)
    state = lookup(F.substring(c, 1, 2), t.STATE_NAMES)
    return F.coalesce(
        lookup(F.substring(c, 1, 6), t.MUNICIPALITIES),
        F.concat(F.lit("Município de "), state, F.lit(" ["), c, F.lit("]")),
        F.concat(F.lit("Município ["), c, F.lit("]")),
    )


def gender(c: Column) -> Column:
    from meridian.functions.text import recode

    return recode(c, {"male": ("1", "M", "MASC", "MASCULINO"), "female": ("2", "3", "F", "FEM", "FEMININO")}, "other", "unknown")


def encounter_class(c: Column) -> Column:
    from meridian.functions.text import recode

    return recode(c, {"EMER": ("02", "2", "03", "3"), "AMB": ("01", "1")}, "IMP")


def compact_date(c: Column) -> Column:
    """yyyymmdd as yyyy-mm-dd, without a look at the calendar; other texts stay, blanks and zeros are null."""
    s = F.substring_index(filled(c), ".", 1)
    shaped = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.isNull() | s.isin("", "0", "00000000") | F.lower(s).isin("nan", "none"), F.lit(None).cast("string")).when(s.rlike("^[0-9]{8}$"), shaped).otherwise(s)


def days_between(later: Column, earlier: Column) -> Column:
    """Days with fractions, rounded half even to two places; 0 if one of the times can't be read."""
    a, b = (F.unix_micros(F.try_to_timestamp(x)) for x in (later, earlier))
    return F.coalesce(F.bround((a - b) / F.lit(86_400_000_000.0), 2), F.lit(0.0))


def coverage_ratio(beneficiaries: Column, code: Column) -> Column:
    population = lookup(strip(code), t.POPULATION, F.lit(t.NO_POPULATION))
    return F.bround(F.try_divide(beneficiaries.cast("double") * 100, population), 2)
