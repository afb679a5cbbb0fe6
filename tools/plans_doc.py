"""Regenerate docs/PLANS.md: formatted physical plans of key queries with
the stand-in feeds stored as Parquet tables (as they would be on a cluster).

    python tools/plans_doc.py /root/testdata/sf0.1 <scratch folder>
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().strip()


def main(sf: str, scratch: str) -> None:
    from meteoframe.operators.merge import upsert_frame
    from meteoframe.plans import dust, forecast, quake, score, typhoon
    from meteoframe.session import build_session
    from meteoframe.sources import feeds, standins as S

    spark = build_session()
    S.hourly_dust(spark, sf).write.partitionBy("DATE").parquet(scratch + "/hourly_dust")
    S.station_master(spark, sf).write.parquet(scratch + "/station_master")
    S.raw_eq_world(spark, sf).write.parquet(scratch + "/raw_eq_world")
    typhoon.clean(S.raw_typhoon(spark, sf)).write.parquet(scratch + "/raw_typhoon")
    S.observations_raw(spark, sf).write.parquet(scratch + "/observations")
    forecast.locate(S.forecast_items(spark, sf), S.coordinates(spark, sf)) \
        .write.parquet(scratch + "/forecast_long")

    raw = spark.read.parquet(scratch + "/hourly_dust")
    st = spark.read.parquet(scratch + "/station_master")
    eq = spark.read.parquet(scratch + "/raw_eq_world")
    ty = spark.read.parquet(scratch + "/raw_typhoon")
    obs = score.observations(spark.read.parquet(scratch + "/observations"), feeds.regions(spark))
    long = spark.read.parquet(scratch + "/forecast_long")
    src = ty.filter("TYP_TM >= '2001-01-01'")

    sections = [
        ("Current dust grades (R6 W1 J1 F8 F13)",
         "Newest snapshot as a literal: partition pruning on DATE; one row per station by struct max "
         "(a sort-based partial aggregate before the exchange); station join broadcast by its size.",
         dust.current_grades(raw, st)),
        ("Domestic region table (R4 F1 W2 A1 J3)",
         "Filters pushed to the Parquet scan, only the used columns read, count and latest report in one "
         "aggregate (no join of two aggregates).",
         quake.region_latest(quake.domestic(eq))),
        ("Foreign region table (R5 A1 A2 J3)",
         "Same single aggregate with count and numeric max.",
         quake.region_max(quake.foreign(eq))),
        ("Typhoon MERGE (K8 J7)",
         "Source deduped by struct max and stored once (its plan is not shown); target LEFT OUTER JOIN source (AQE can split a skewed left side) "
         "plus source LEFT ANTI JOIN the target's distinct keys; no full outer join.",
         upsert_frame(ty, src, typhoon.KEYS, typhoon.latest_first())),
        ("Weekly summary (R10 J4 A5 A6 F21)",
         "Region and holiday tables are local relations (the calendar is made distinct first); one hash "
         "aggregate per region-week with exact decimal sums and a timestamp max, combined map-side.",
         score.weekly_summary(score.weekend_or_holiday(obs, S.holidays(spark)))),
        ("Forecast pivot (A8 Q4 F9)",
         "Fixed category list as conditional aggregates in one aggregate (sort-based, since the cells are "
         "strings; partial before the exchange); the key check (raise_error on a repeated cell) rides "
         "in the same pass.",
         forecast.wide(long)),
    ]
    out = ["# Physical plans of key queries", "",
           "Generated by `tools/plans_doc.py` with `DataFrame.explain(\"formatted\")` (Spark "
           f"{spark.version}, AQE initial plans) on the {os.path.basename(sf.rstrip('/'))} stand-in feeds",
           "written as Parquet tables (hourly dust partitioned by DATE), i.e. as the tables would be "
           "stored on a cluster.", ""]
    for title, note, df in sections:
        out += [f"## {title}", "", note, "", "```", plan(df), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
