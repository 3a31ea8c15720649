"""Key and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
# Phase by movement-code range (inclusive bounds); anything else is 'outro'.
PHASES = (
    (1, 99, "distribuição"),
    (100, 199, "conhecimento"),
    (200, 299, "instrução"),
    (300, 399, "sentença"),
    (400, 499, "recurso"),
    (500, 599, "execução"),
    (600, 699, "arquivamento"),
)
PHASE_OTHER = "outro"
# Null stand-in and separator of the public surrogate-key macro.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
# English day names (locale of the date formatter), Monday = 1.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def phase_bucket(code: str | Column) -> Column:
    """Movement code -> phase label."""
    code = _col(code)
    expr = None
    for lo, hi, label in PHASES:
        cond = code.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(PHASE_OTHER)


def date_key(c: str | Column) -> Column:
    """date/timestamp -> int yyyyMMdd (null stays null). Years of four digits by arithmetic, without a text."""
    d = F.to_date(_col(c))
    return (F.when(F.year(d).between(1, 9999), F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d))
            .otherwise(F.date_format(d, "yyyyMMdd").cast("int")))


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the text of each column, nulls replaced, '-' between. Order matters."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def weekday_ordinal(day_name: str | Column) -> Column:
    """English day name -> 1..7 (Monday = 1); other text -> null."""
    day_name = _col(day_name)
    expr = None
    for i, name in enumerate(WEEKDAYS, start=1):
        expr = F.when(day_name == name, i) if expr is None else expr.when(day_name == name, i)
    return expr


def iso_weekday(d: str | Column) -> Column:
    """Day-of-week 1..7 (Monday = 1) straight from a date, locale-free."""
    return F.weekday(_col(d)) + 1


def week_label(year: str | Column, week: str | Column) -> Column:
    """B11: 'YYYY-Www'."""
    return F.concat(_col(year).cast("string"), F.lit("-W"), F.lpad(_col(week).cast("string"), 2, "0"))
