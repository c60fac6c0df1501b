"""Time parsing and formatting.  All times are UTC; jobs pin the session zone to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso_text(ts: Column) -> Column:
    """Timestamp to ``YYYY-MM-DDTHH:MM:SSZ`` text (sub-seconds are cut)."""
    return F.date_format(ts, ISO_SECONDS)


def parse_iso(text: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` text to timestamp; NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit(ISO_SECONDS))


def from_epoch_millis(millis: Column) -> Column:
    return F.date_trunc("second", F.timestamp_millis(millis))


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def ensure_z(text: Column) -> Column:
    return F.when(text.endswith("Z"), text).otherwise(F.concat(text, F.lit("Z")))


def date_and_hhmm_text(date_text: Column, hhmm_text: Column) -> Column:
    """ISO date text and an HHMM text of up to four digits to ISO text."""
    padded = F.when(F.length(hhmm_text) < 4, F.lpad(hhmm_text, 4, "0")).otherwise(hhmm_text)
    return F.concat(
        date_text,
        F.lit("T"),
        F.substring(padded, 1, 2),
        F.lit(":"),
        padded.substr(F.lit(3), F.length(padded)),
        F.lit(":00Z"),
    )


def day_first_date_and_hhmm(date_text: Column, hhmm: Column, fallback: str) -> Column:
    """``DD-MM-YYYY`` text plus an HHMM integer to ISO text, else ``fallback``."""
    clock = F.format_string("%s %02d:%02d", date_text, (hhmm / 100).cast("int"), hhmm % 100)
    parsed = F.try_to_timestamp(clock, F.lit("d-M-yyyy HH:mm"))
    return F.coalesce(iso_text(parsed), F.lit(fallback))


def month_name(year: Column, month: Column) -> Column:
    return F.date_format(F.make_date(year, month, F.lit(1)), "MMMM")


def time_key_text(time_id: Column) -> Column:
    """The number yyyymmddhh to ``YYYY-MM-DD HH:00:00`` text."""
    digits = F.lpad(time_id.cast("string"), 10, "0")
    parts = [F.substring(digits, at, n) for at, n in ((1, 4), (5, 2), (7, 2), (9, 2))]
    return F.concat(F.concat_ws("-", *parts[:3]), F.lit(" "), parts[3], F.lit(":00:00"))
