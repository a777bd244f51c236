"""Wall-clock time helpers. No function here reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

Moment = str | dt.datetime | dt.date

# A calendar date, optionally followed by a time and a zone, with or without
# separators, and the parts of it. More than six digits of a second are cut.
ISO_MOMENT = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)


def wall_clock(moment: Moment) -> Column:
    """A literal wall-clock timestamp."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def calendar_day(moment: Moment) -> Column:
    """A literal date; the time of day, if any, is cut off."""
    return F.lit(str(moment)[:10]).cast("date")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to wall-clock time. The zone is dropped, bad text gives null.

    A text is matched once: its parts are put between marks, and those left empty are
    filled by plain replacement. A text without marks did not match.
    """
    plain = F.regexp_replace(text, ISO_MOMENT, "#$1-$2-$3 $4:$5:$6.$7#")
    for empty, full in ((" :", " 00:"), ("::", ":00:"), (":.", ":00."), (".#", ".0#")):
        plain = F.replace(plain, F.lit(empty), F.lit(full))
    marked = F.split_part(plain, F.lit("#"), F.lit(2))
    return F.when(~F.contains(text, F.lit("#")), marked.try_cast("timestamp_ntz"))


def hours_between(earlier: Column, later: Column) -> Column:
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return micros.cast("double") / 3.6e9


def iso_day(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
