"""Column parsers. All built-in expressions: they stay
inside whole-stage codegen and never leave the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the filing-date formats, tried
# in this order, the event-time format, and the case-number layout
# (7 sequence, 2 check digits, 4 year, 1 justice segment, 2 court, 4 origin).
FILING_TS_FORMATS = (
    "yyyyMMddHHmmss",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)
EVENT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
CASE_NUMBER_DIGITS = 20
CASE_NUMBER_PARTS = (
    ("cnj_sequencial", 7, False),
    ("cnj_digitos", 2, False),
    ("cnj_ano", 4, True),
    ("cnj_justica", 1, True),
    ("cnj_cod_tribunal", 2, True),
    ("cnj_origem", 4, False),
)
SUBJECT_DDL = "struct<codigo:bigint,nome:string>"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_filing_ts(c: str | Column) -> Column:
    """First format that parses wins; anything else is null (no error under ANSI).

    A format is tried only on text of its shape (a time after 'T', a fraction after '.', dashes past a sign): a
    failed parse costs an exception, many times a parse.
    """
    c = _col(c)
    time, fraction, dashed = F.upper(c).contains("T"), c.contains("."), F.substring(c, 2, 1 << 30).contains("-")
    shapes = (~dashed & ~time & ~fraction, dashed & time & fraction, dashed & time & ~fraction, dashed & ~time & ~fraction)
    return F.coalesce(*[F.when(shape, F.try_to_timestamp(c, F.lit(f))) for shape, f in zip(shapes, FILING_TS_FORMATS, strict=True)])


def parse_event_ts(c: str | Column) -> Column:
    """Drop a trailing 'Z', then one format with millis; else null."""
    c = _col(c)
    bare = F.when(c.endswith("Z"), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)
    return F.try_to_timestamp(bare, F.lit(EVENT_TS_FORMAT))


def case_number_parts(c: str | Column) -> dict[str, Column]:
    """Strip non-digits once, split into 6 segments.

    The first 20 digits count; fewer give '' for the text segments and null for the integer ones.
    """
    return parts_of_digits(case_number_digits(c))


def case_number_digits(c: str | Column) -> Column:
    """The digits of a case number."""
    return F.regexp_replace(_col(c), "[^0-9]", "")


def parts_of_digits(digits: str | Column) -> dict[str, Column]:
    """The segments of ``case_number_digits``. Where these are a column, they are stripped once, not once a segment."""
    digits = _col(digits)
    out, at = {}, 1
    for name, width, as_int in CASE_NUMBER_PARTS:
        seg = F.when(F.length(digits) < CASE_NUMBER_DIGITS, F.lit("")).otherwise(F.substring(digits, at, width))
        out[name], at = seg.try_cast("int") if as_int else seg, at + width
    return out


def parse_json_array(c: str | Column, ddl: str = SUBJECT_DDL) -> Column:
    """B3 helper: array<string> of JSON objects -> array<struct>; bad JSON -> null fields."""
    return F.transform(_col(c), lambda x: F.from_json(x, ddl))


def json_field(c: str | Column, ddl: str) -> Column:
    """JSON text column -> struct by DDL; malformed text gives null fields."""
    return F.from_json(_col(c), ddl)


def clamp_date(text: str | Column) -> Column:
    """B12: 'Y-M-D' text -> date with month clamped to 1..12 and day to 1..last day.

    Text that is not three integers gives null (the caller decides whether
    that is an error: see ``sources.extract.require_dates``).
    """
    parts = F.split(_col(text), "-")
    ok = F.size(parts) == 3
    y = F.when(ok, F.get(parts, 0).try_cast("int"))
    m = F.greatest(F.lit(1), F.least(F.get(parts, 1).try_cast("int"), F.lit(12)))
    d = F.get(parts, 2).try_cast("int")
    first = F.make_date(y, m, F.lit(1))
    last = F.dayofmonth(F.last_day(first))
    return F.make_date(y, m, F.greatest(F.lit(1), F.least(d, last)))


def array_first(c: str | Column) -> Column:
    """First element, null-safe for null or empty arrays."""
    return F.get(_col(c), 0)
