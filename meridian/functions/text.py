"""Text functions with the semantics that the sources' codes need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All ASCII white space: SQL trim takes blanks only.
WHITE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITE))


def filled(c: Column) -> Column:
    """The stripped text, null if nothing is left."""
    s = strip(c)
    return F.when(s != "", s)


def digits(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "[^0-9]", "")


def zero_pad(c: Column, n: int) -> Column:
    """Padded with zeros; longer texts stay whole, where lpad would cut them."""
    return F.when(F.length(c) >= n, c).otherwise(F.lpad(c, n, "0"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is computed once a row: the optimizer would copy it to every place that it stands in."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lookup(c: Column, table: dict, default: Column | None = None) -> Column:
    """A small fixed table as a literal map: no join and no shuffle."""
    if not table:
        return default if default is not None else F.lit(None)
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)
    return found if default is None else F.coalesce(found, default)


def recode(c: Column, groups: dict[str, tuple[str, ...]], default: str, if_null: str | None = None) -> Column:
    """The name of the group that holds the stripped upper-case value."""
    v = F.upper(strip(c))
    out = F.when(c.isNull(), F.lit(if_null if if_null is not None else default))
    for name, values in groups.items():
        out = out.when(v.isin(*values), F.lit(name))
    return out.otherwise(F.lit(default))


def salted_hash(c: Column, salt: str) -> Column:
    """Hex SHA-256 of the stripped text and the salt; null for null and blank."""
    return F.sha2(F.concat(filled(c), F.lit(salt)), 256)


def is_hash(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def decimal_number(c: Column) -> Column:
    """A number written with a comma or a point; null if it is none."""
    return F.replace(strip(c), F.lit(","), F.lit(".")).try_cast("double")


def whole_number(c: Column) -> Column:
    """The whole part of a written number; null if it is none."""
    return strip(c).try_cast("double").try_cast("int")


def share(part: Column, whole: Column, factor: float = 100.0) -> Column:
    return F.try_divide(part * F.lit(factor), whole)


def differs(a: Column, b: Column) -> Column:
    """a != b, true also where one of them is null."""
    return F.coalesce(a != b, F.lit(True))
