"""Run-date variables, day offsets and schedules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date-shaped variables that take day offsets, and all system variables.
DATE_VARIABLES = ("bizdate", "yyyymmdd")
KNOWN_VARIABLES = ("bizdate", "yyyymmdd", "cyctime")
# The schedule of a workflow that names none, and the date text of
# a system variable before a run sets it.
DEFAULT_SCHEDULE = "00 02 00 * * ?"
SYSTEM_PLACEHOLDER = "19700101"


def bizdate(run_ts: Column) -> Column:
    """Business date: the day before the run, as yyyyMMdd."""
    return F.date_format(F.date_sub(run_ts.cast("date"), 1), "yyyyMMdd")


def run_day(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyyMMdd")


def cycle_time(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyyMMddHHmm")


def shift_day(day_text: Column, days: int | Column) -> Column:
    """``$[yyyymmdd±N]``: move a yyyyMMdd text by whole days."""
    day = F.to_date(day_text, "yyyyMMdd")
    return F.date_format(F.date_add(day, days), "yyyyMMdd")


def offset_value(name: Column, day_text: Column, days: Column) -> Column:
    """Offset of a named variable; null where the variable is not a date."""
    return F.when(name.isin(*DATE_VARIABLES), shift_day(day_text, days))


def five_field_schedule(cron: Column) -> Column:
    """Drop the seconds of a six-field schedule; shorter texts stay as they are."""
    parts = F.split(F.trim(F.regexp_replace(cron, r"\s+", " ")), " ")
    five = F.replace(F.array_join(F.slice(parts, 2, 5), " "), F.lit("?"), F.lit("*"))
    return F.when(F.size(parts) >= 6, five).otherwise(cron)


def last_five_fields(cron: Column) -> Column:
    """The part of a schedule that parity compares; short texts as they are."""
    parts = F.split(F.trim(F.regexp_replace(cron, r"\s+", " ")), " ")
    size = F.size(parts)
    return F.when(size >= 5, F.array_join(F.slice(parts, F.greatest(size - 4, F.lit(1)), F.lit(5)), " ")).otherwise(cron)
