"""Scalar expressions used by staging, aggregates and queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P

_NON_ALNUM = r"([^\p{L}\p{N}])"


def title_case(c: Column | str) -> Column:
    """Title case where any non-alphanumeric character starts a new word.

    ``F.initcap`` only breaks words at spaces (``Mary-jane``); this gives ``Mary-Jane O'Brien``.
    A space is put after every non-alphanumeric character, ``initcap`` capitalises each word and
    lowers the rest, and the inserted spaces are removed again (each non-alphanumeric character
    is followed by exactly one inserted space, so the pairs are matched left to right). Built-in
    regexp/initcap only, so the projection stays inside whole-stage codegen.
    """
    c = F.col(c) if isinstance(c, str) else c
    spaced = F.regexp_replace(F.lower(c), _NON_ALNUM, "$1 ")
    return F.regexp_replace(F.initcap(spaced), _NON_ALNUM + " ", "$1")


def text_to_timestamp(c: Column | str, strict: bool = True) -> Column:
    """Text -> instant in the session time zone. Strict raises on malformed text (ANSI cast)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp") if strict else c.try_cast("timestamp")


def text_to_date(c: Column | str, strict: bool = True) -> Column:
    """Date part of the text itself (not of the instant; they differ off UTC near midnight)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date") if strict else c.try_cast("date")


def epoch_seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds of (end - start), rounded half up, as int."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.round(micros.cast("decimal(20,0)") / F.lit(1_000_000), 0).cast("int")


def guarded_duration_sec(start: Column, end: Column) -> Column:
    """Duration when end is after start, else 0 (clock errors, equal times, NULLs)."""
    return F.when(end > start, epoch_seconds_between(start, end)).otherwise(F.lit(0))


def bucket_label(duration: Column, short_max: int = P.SHORT_SESSION_MAX_SEC,
                 medium_max: int = P.MEDIUM_SESSION_MAX_SEC) -> Column:
    return (F.when(duration < short_max, F.lit("short"))
            .when(duration < medium_max, F.lit("medium"))
            .otherwise(F.lit("long")))


def month_start(ts: Column) -> Column:
    """First day of the month of a timestamp, as a date (NULL stays NULL)."""
    return F.trunc(ts.cast("date"), "month")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return num / F.nullif(den, F.lit(0))


def round_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) with decimal division and HALF_UP rounding."""
    return F.round(safe_ratio(num, den), scale)


def struct_json(row: Column | str) -> Column:
    """A struct as a JSON object with every field, NULLs written as null."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def row_json(cols: list[str]) -> Column:
    """The row as a JSON object with every column, NULLs written as null."""
    return struct_json(F.struct(*[F.col(c) for c in cols]))
