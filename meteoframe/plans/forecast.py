"""Short-range forecast: locate, pivot, label, alert, upsert, retain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.functions.numeric import safe_double
from meteoframe.functions.text import location_name
from meteoframe.functions.weather import (discomfort_alert, discomfort_index, pty_label,
                                          sky_label, strong_wind_alert)
from meteoframe.operators.joins import join_dimension
from meteoframe.operators.merge import retain, upsert_frame
from meteoframe.operators.reshape import pivot_checked, pivot_open

KEYS = ["BASE_DATE", "FCST_DATE", "FCST_TIME", "LOCATION"]
WIDE_COLUMNS = ["BASE_DATE", "BASE_TIME", "FCST_DATE", "FCST_TIME", "NX", "NY", "LOCATION",
                "BROAD_LOCATION", "WSD", "VEC", "TMP", "POP", "REH", "SKY", "PTY",
                "STRONG_WIND_ALERT", "DI", "DISCOMFORT_ALERT"]


def locations(coords: DataFrame) -> DataFrame:
    """(nx, ny, LOCATION, BROAD_LOCATION) per requested location."""
    return coords.select("nx", "ny", location_name("level1", "level2").alias("LOCATION"),
                         F.col("level1").alias("BROAD_LOCATION"))


def locate(items: DataFrame, coords: DataFrame) -> DataFrame:
    """Tag items with every location on their grid cell (1:N when two
    locations share a cell, as separate requests would)."""
    return join_dimension(items, locations(coords), ["nx", "ny"])


def wide(long: DataFrame, categories=(*K.FORECAST_CATEGORIES, *K.FORECAST_OTHERS)) -> DataFrame:
    """Pivot categories into the fixed column list; numeric ones coerced.

    A repeated (index, category) or a category outside ``categories`` fails
    the job from inside the pivot.
    """
    w = pivot_checked(long, K.FORECAST_INDEX, "category", "fcstValue", categories)
    for c in K.FORECAST_NUMERIC:
        w = w.withColumn(c, safe_double(c))
    return w


def wide_open(long: DataFrame) -> DataFrame:
    """As ``wide`` with every category that occurs as a column (in name order),
    known or not; known numeric ones are numbers."""
    w = pivot_open(long, K.FORECAST_INDEX, "category", "fcstValue")
    return w.withColumns({c: safe_double(c) for c in K.FORECAST_NUMERIC if c in w.columns})


def process(w: DataFrame, base_date: str, others: bool = False) -> DataFrame:
    """Labels, alerts and discomfort index; renamed to the table's columns;
    forecasts before ``base_date`` ('yyyyMMdd' text order) dropped.  With
    ``others`` the feed's further categories follow (for the export)."""
    di = discomfort_index("TMP", "REH")
    out = (w.withColumn("SKY", sky_label("SKY"))
           .withColumn("PTY", pty_label("PTY"))
           .withColumn("STRONG_WIND_ALERT", strong_wind_alert("WSD"))
           .withColumn("DI", di)
           .withColumn("DISCOMFORT_ALERT", discomfort_alert(di))
           .withColumnsRenamed(K.FORECAST_RENAME))
    extra = [c for c in w.columns if c in K.FORECAST_OTHERS] if others else []
    return out.filter(F.col("FCST_DATE") >= F.lit(base_date)).select(*WIDE_COLUMNS, *extra)


def upsert(target: DataFrame, source: DataFrame) -> DataFrame:
    """MERGE ON (BASE_DATE, FCST_DATE, FCST_TIME, LOCATION); BASE_TIME is
    among the updated columns, so a later run of the same day replaces."""
    return upsert_frame(target, source, KEYS, order=[("BASE_TIME", False)])


def retention(target: DataFrame, base_date: str) -> DataFrame:
    """DELETE WHERE FCST_DATE < base_date."""
    return retain(target, ~(F.col("FCST_DATE") < F.lit(base_date)))
