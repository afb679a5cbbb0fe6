"""The holiday calendar by rule: fixed dates, dates that follow the moon, and
substitute days, for any years that the lunar table covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.sources.feeds import inline_rows

#: Years from which a festival's Sunday, and Buddha's birthday, get a substitute.
FESTIVAL_SUBSTITUTE, BIRTHDAY_SUBSTITUTE = 2014, 2023


def covered(lunar: list[tuple] = K.HOLIDAY_LUNAR) -> tuple[str, str]:
    """First and last day that ``calendar`` knows."""
    years = sorted(row[0][:4] for row in lunar)
    return f"{years[0]}-01-01", f"{years[-1]}-12-31"


def named_days(spark: SparkSession, lunar: list[tuple] = K.HOLIDAY_LUNAR) -> DataFrame:
    """Every holiday by its own rule: ``day``, ``name`` (of the rule), and whether
    a Saturday, a Sunday or a clash with another holiday earns a substitute."""
    first, last = (int(d[:4]) for d in covered(lunar))
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    fixed = (years.withColumn("r", F.explode(F.array(*[F.struct(F.lit(md).alias("md"), F.lit(a).alias("a"), F.lit(z).alias("z"), F.lit(s).alias("s"))
                                                       for md, a, z, s in K.HOLIDAY_FIXED])))
             .where((F.col("year") >= F.col("r.a")) & (F.col("year") <= F.col("r.z")))
             .select(F.to_date(F.concat_ws("-", "year", "r.md")).alias("day"), F.col("r.md").alias("name"),
                     ((F.col("r.s") > 0) & (F.col("year") >= F.col("r.s"))).alias("substituted"), F.lit(True).alias("saturday")))
    moon = inline_rows(spark, lunar, "new_year date, birthday date, autumn date")

    def festival(column: str) -> DataFrame:
        return moon.select(F.explode(F.sequence(F.date_sub(column, 1), F.date_add(column, 1))).alias("day"), F.lit(column).alias("name"),
                           (F.year(column) >= FESTIVAL_SUBSTITUTE).alias("substituted"), F.lit(False).alias("saturday"))

    birthday = moon.select(F.col("birthday").alias("day"), F.lit("birthday").alias("name"), (F.year("birthday") >= BIRTHDAY_SUBSTITUTE).alias("substituted"),
                           F.lit(True).alias("saturday"))
    return fixed.unionByName(festival("new_year")).unionByName(festival("autumn")).unionByName(birthday)


def calendar(spark: SparkSession, lunar: list[tuple] = K.HOLIDAY_LUNAR, extra: list[str] = K.HOLIDAY_EXTRA) -> DataFrame:
    """``holiday`` (date) of every public holiday in the years of ``lunar``, the
    input of ``score.day_flags``; ``extra`` adds single days.

    A holiday that earns one, and falls on a Sunday, on a Saturday (festivals:
    not) or on another holiday's day, is substituted by the next day that is
    neither weekend nor holiday.
    """
    days = named_days(spark, lunar)
    known = days.select("day").unionByName(inline_rows(spark, [(d,) for d in extra], "day date")).distinct()
    shared = days.groupBy("day").agg(F.count_distinct("name").alias("names"), F.max("substituted").alias("substituted"),
                                     F.max(F.col("substituted") & F.col("saturday")).alias("saturday"))
    weekday = F.weekday("day")
    due = shared.where(F.col("substituted") & ((weekday == 6) | (F.col("names") > 1)) | F.col("saturday") & (weekday == 5)).select(F.col("day").alias("of"))
    later = due.select("of", F.explode(F.sequence(F.date_add("of", 1), F.date_add("of", 10))).alias("day")).where(F.weekday("day") < 5)
    free = later.join(known, "day", "left_anti").groupBy("of").agg(F.min("day").alias("day"))
    return known.unionByName(free.select("day")).distinct().withColumnRenamed("day", "holiday")
