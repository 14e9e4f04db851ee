"""Date and time expressions.

Parsed values are ``timestamp_ntz`` (wall-clock, like the naive datetimes the
reports carry), so results never depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone of the load stamp and its text format.
PACIFIC = "America/Los_Angeles"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
DEFAULT_DATE_FORMAT = "M/d/yyyy"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_literal(as_of) -> Column:
    """A wall-clock ``timestamp_ntz`` literal.  Built from text: a Python
    datetime literal would be read in the session time zone."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(as_of, _dt.date):
        return F.lit(as_of.isoformat()).cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


_lit_ts = ts_literal


def utc_wall_clock(col) -> Column:
    """An instant (``timestamp``) as its UTC wall-clock ``timestamp_ntz``,
    exactly and whatever the session time zone; NTZ passes through."""
    c = _c(col)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch)


def parse_timestamp(col, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    """Strict parse; '' and null -> null; other bad text raises (ANSI)."""
    return F.to_timestamp_ntz(F.nullif(_c(col), F.lit("")), F.lit(fmt))


def parse_date(col, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    """Strict parse to a date."""
    return F.to_date(parse_timestamp(col, fmt))


def _shape(fmt: str) -> str | None:
    """A pattern that every text of a format of digits matches; None for others."""
    parts = re.findall(r"y+|M{1,2}|d+|H+|m+|s+|[-/:. ]", fmt)
    if "".join(parts) != fmt or "MMM" in fmt:
        return None
    return "^" + "".join("[+-]?[0-9]+" if p[0].isalpha() else re.escape(p) for p in parts) + "$"


def try_parse_timestamp(col, formats: Sequence[str] = (DEFAULT_DATE_FORMAT,)) -> Column:
    """First format that parses wins; bad text -> null.

    ``try_to_timestamp`` decides whether the text parses; the value is then
    parsed as wall-clock ``timestamp_ntz`` (no session-zone round trip).  A
    failed parse costs an exception, so only text of the format's shape is tried."""
    c = _c(col)

    def parsed(f: str) -> Column:
        parses, shape = F.try_to_timestamp(c, F.lit(f)).isNotNull(), _shape(f)
        shaped = F.lit(True) if shape is None else (F.typeof(c) != "string") | c.cast("string").rlike(shape)
        return F.when(shaped & parses, F.to_timestamp_ntz(c, F.lit(f)))

    return F.coalesce(*[parsed(f) for f in formats])


def days_until(col, as_of) -> Column:
    """Whole days from ``as_of`` (midnight) to the date in ``col``."""
    return F.datediff(F.to_date(_c(col)), F.to_date(_lit_ts(as_of)))


def reformat_date(col, in_fmt: str = "yyyy-MM-dd", out_fmt: str = "MM/dd/yy") -> Column:
    """D5 with C16: first 10 chars parsed as ISO date, rendered as text."""
    return F.date_format(F.to_date(F.substring(_c(col), 1, 10), in_fmt), out_fmt)


def utc_to_pacific(col) -> Column:
    """Wall-clock UTC -> wall-clock Pacific, both timestamp_ntz."""
    return F.convert_timezone(F.lit("UTC"), F.lit(PACIFIC), _c(col).cast("timestamp_ntz"))


def pacific_stamp(as_of) -> Column:
    """The load stamp, ``as_of`` (UTC) in Pacific as ISO text."""
    return F.date_format(utc_to_pacific(_lit_ts(as_of)), STAMP_FORMAT)


def utc_instant(c: Column) -> Column:
    """A zone-less time as the instant that UTC clocks show it, in any session zone."""
    seconds = (c - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))
