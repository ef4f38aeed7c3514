"""Column expressions of the registry: identifiers, names, null-safe tests, casts, periods."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of the first eight digits of an organisation number.
WEIGHTS = (3, 2, 7, 6, 5, 4, 3, 2)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_org_nr(c: Column | str) -> Column:
    """Whether a text is nine digits from 8 or 9 on with a right mod-11 check digit (F1); NULL is not valid."""
    c = col(c)
    total = sum((F.substring(c, i + 1, 1).try_cast("int") * w for i, w in enumerate(WEIGHTS)), F.lit(0))
    check = F.pmod(11 - F.pmod(total, F.lit(11)), F.lit(11))
    right = (check != 10) & (check == F.substring(c, 9, 1).try_cast("int"))
    return F.coalesce(F.when(c.rlike(r"^[89][0-9]{8}$"), right), F.lit(False))


def is_org_nr(text: str) -> bool:
    """The same of one text."""
    if not re.fullmatch(r"[89][0-9]{8}", text):
        return False
    check = -sum(int(d) * w for d, w in zip(text, WEIGHTS)) % 11
    return check != 10 and check == int(text[8])


def snake_name(path: str) -> str:
    """A source path as a column name."""
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", path).replace(".", "_").lower()


def to_snake(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(col(c), "([a-z0-9])([A-Z])", "$1_$2"), r"\.", "_"))


def person_id(birth_date: Column | str, last: Column | str, first: Column | str, middle: Column | str) -> Column:
    """birth_last_first_middle in lower case (P10); NULL without birth date or last name, NULL first names print as NA."""
    birth, last = col(birth_date).cast("string"), col(last)
    text = F.concat(birth, F.lit("_"), last, F.lit("_"), F.coalesce(col(first), F.lit("NA")), F.lit("_"), F.coalesce(col(middle), F.lit("")))
    return F.when(birth.isNotNull() & last.isNotNull(), F.lower(text))


def same(a: Column | str, b: Column | str) -> Column:
    """Null-safe equality."""
    return col(a).eqNullSafe(col(b))


def is_true(c: Column | str) -> Column:
    return col(c).eqNullSafe(F.lit(True))


def active_role(resigned: Column | str = "resigned", deregistered: Column | str = "deregistered") -> Column:
    """Neither resigned nor deregistered; unknown counts as active."""
    return ~is_true(resigned) & ~is_true(deregistered)


def flag_set(c: Column | str) -> Column:
    """Whether a flag reads true, t or 1."""
    return F.coalesce(F.lower(F.trim(col(c))).isin("true", "t", "1"), F.lit(False))


def shown(c: Column | str, kind: str) -> Column:
    """A value as text: logical values in upper case, others as they are cast."""
    return F.upper(col(c).cast("string")) if kind == "boolean" else col(c).cast("string")


def as_type(c: Column | str, kind: str) -> Column:
    """A text as a typed value; what can't be read is NULL. Whole numbers are cut from decimals."""
    c = col(c)
    if kind == "date":
        return F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd") if hasattr(F, "try_to_date") else c.try_cast("date")
    if kind == "boolean":
        low = F.lower(c.cast("string"))
        return F.when(low.isin("true", "t"), True).when(low.isin("false", "f"), False)
    if kind in ("int", "bigint", "long"):
        return c.try_cast("double").try_cast("bigint").try_cast(kind)
    return c.try_cast(kind)


def format_period(date: Column | str, frequency: str) -> Column:
    """2024, 2024-Q3 or 2024-07."""
    date = col(date)
    if frequency == "year":
        return F.date_format(date, "yyyy")
    if frequency == "quarter":
        return F.concat(F.date_format(date, "yyyy"), F.lit("-Q"), F.quarter(date).cast("string"))
    return F.date_format(date, "yyyy-MM")


def parse_period(c: Column | str) -> Column:
    """A date from YYYY, YYYY-MM, YYYY-Qn or a full date (E5): the first day of the period."""
    c = col(c).cast("string")
    quarter = (F.substring(c, 7, 1).try_cast("int") - 1) * 3 + 1
    return (
        F.when(c.rlike(r"^\d{4}$"), F.concat(c, F.lit("-01-01")).try_cast("date"))
        .when(c.rlike(r"^\d{4}-\d{2}$"), F.concat(c, F.lit("-01")).try_cast("date"))
        .when(c.rlike(r"^\d{4}-Q[1-4]$"), F.make_date(F.substring(c, 1, 4).try_cast("int"), quarter, F.lit(1)))
        .otherwise(c.try_cast("date"))
    )
