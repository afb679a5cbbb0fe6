"""Time grids: the request stamps a scheduled run covers, per run date.

Each run date expands on its own row (``sequence`` + ``explode``), so the
work is spread over whatever partitions hold the run dates; nothing is built
on the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_stamps(start, end, hours: Sequence[int] = (0, 6, 12, 18),
               step_days: int = 1) -> Column:
    """Array of timestamps: every ``step_days``-th day from start to end
    (inclusive) at each of ``hours``."""
    days = F.sequence(F.to_date(_c(start)), F.to_date(_c(end)),
                      F.expr(f"INTERVAL {int(step_days)} DAY"))
    hrs = F.array(*[F.lit(int(h)) for h in hours])
    return F.flatten(F.transform(days, lambda d: F.transform(
        hrs, lambda h: F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                            h, F.lit(0), F.lit(0)))))


def expand_grid(df: DataFrame, start, end, hours=(0, 6, 12, 18), step_days: int = 1,
                out: str = "stamp") -> DataFrame:
    """One row per (input row, stamp)."""
    return df.withColumn(out, F.explode(day_stamps(start, end, hours, step_days)))


def month_days(run_date) -> Column:
    """Every day of the month before ``run_date``."""
    first_this = F.trunc(_c(run_date), "MM")
    return F.sequence(F.add_months(first_this, -1), F.date_sub(first_this, 1),
                      F.expr("INTERVAL 1 DAY"))
