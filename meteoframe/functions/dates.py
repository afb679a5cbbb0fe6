"""Timestamp parsing/formatting, weekdays, week windows (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.functions.text import _c

# Feed timestamp layouts.
STAMP_MINUTE = "yyyyMMddHHmm"      # observations, typhoon TYP_TM
STAMP_SECOND = "yyyyMMddHHmmss"    # earthquake eqDate
STATION_STAMP = "yyyy.MM.dd.HH:mm"  # daily dust kst, station validity
READABLE = "yyyy-MM-dd HH:mm"
ISO_SECOND = "yyyy-MM-dd HH:mm:ss"


def parse_ts(c, fmt: str) -> Column:
    """Lenient parse: text that does not match fmt (or hour 24) -> null."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def fmt_ts(c, fmt: str) -> Column:
    return F.date_format(_c(c), fmt)


def hour_stamp(c) -> Column:
    """Truncate to the hour, as 'yyyyMMddHH00'."""
    return F.date_format(F.date_trunc("hour", _c(c)), "yyyyMMddHH00")


def month_text(c) -> Column:
    """Month period as 'yyyy-MM'."""
    return F.date_format(_c(c), "yyyy-MM")


def month_to_date(month_text_col) -> Column:
    """'yyyy-MM' -> first day of the month as a date."""
    return F.try_to_date(F.concat(_c(month_text_col), F.lit("-01")), "yyyy-MM-dd")


def weekday(c) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(c))


def weekday_label(c) -> Column:
    return F.substring(F.lit(K.WEEKDAY_LABELS), weekday(c) + 1, 1)


def is_weekend(c) -> Column:
    return weekday(c) >= 5


def week_start(c) -> Column:
    """Monday of the ISO week holding c, as a date."""
    return F.to_date(F.date_trunc("week", _c(c)))


def day_range_bounds(day_col) -> tuple[Column, Column]:
    """[day 00:00:00, day + 1 day - 1 second] for a BETWEEN filter."""
    start = F.to_timestamp(_c(day_col)).cast("timestamp_ntz")
    end = start + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 SECOND")
    return start, end


def last_week_range(run_date) -> tuple[Column, Column]:
    """Monday 0000 .. Sunday 2300 before the run date, as 'yyyyMMddHHmm' text."""
    end = F.date_sub(_c(run_date), 1)
    start = F.date_sub(end, 6)
    return (F.concat(F.date_format(start, "yyyyMMdd"), F.lit("0000")),
            F.concat(F.date_format(end, "yyyyMMdd"), F.lit("2300")))


def previous_month_bounds(run_date) -> tuple[Column, Column]:
    """First and last day of the month before run_date."""
    first_this = F.trunc(_c(run_date), "MM")
    return F.add_months(first_this, -1), F.date_sub(first_this, 1)


def ts_text(c) -> Column:
    """Timestamp as text 'yyyy-MM-dd HH:mm:ss' (null stays null)."""
    return F.date_format(_c(c), ISO_SECOND)
