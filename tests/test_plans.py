"""Plan shape on stored tables: filters and column pruning reach the scan,
the newest-snapshot filter prunes partitions, dimension joins broadcast only
when checked, and no plan holds a cartesian product or Python evaluation."""

import contextlib
import io
import uuid

from meteoframe.plans import dust, quake
from meteoframe.sources import standins as S

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _clean(plan: str):
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_snapshot_filter_prunes_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/hourly_{uuid.uuid4().hex[:6]}"
    S.hourly_dust(spark, SF).write.partitionBy("DATE").parquet(path)
    raw = spark.read.parquet(path)
    out = dust.current_grades(raw, S.station_master(spark, SF))
    plan = _plan(out)
    newest = raw.agg({"DATE": "max"}).first()[0]
    assert "PartitionFilters: [isnotnull(DATE" in plan and str(newest) in plan
    _clean(plan)
    assert out.count() > 0


def test_domestic_filters_pushed_and_columns_pruned(spark, tmp_dir):
    path = f"{tmp_dir}/eq_{uuid.uuid4().hex[:6]}"
    S.raw_eq_world(spark, SF).write.parquet(path)
    region = quake.region_latest(quake.domestic(spark.read.parquet(path)))
    plan = _plan(region)
    assert "PushedFilters: [IsNotNull(nkDiv), IsNotNull(cntDiv), IsNotNull(msgCode), EqualTo(nkDiv,N)" in plan
    read_schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "reFer" not in read_schema and "magMl" not in read_schema  # only the used columns are read
    # one aggregate, no join between two aggregates
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert "partial_count" in plan
    _clean(plan)


def test_merge_and_replace_read_only_touched_partitions(spark, tmp_dir):
    from pyspark.sql import functions as F
    from meteoframe import sinks
    path = f"{tmp_dir}/t_{uuid.uuid4().hex[:6]}"
    spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("p")).write.partitionBy("p").parquet(path)
    touched = sinks.partition_values(spark.range(3).select((F.col("id") % 2).cast("int").alias("p")), "p")
    plan = _plan(spark.read.parquet(path).filter(sinks.in_partitions("p", [*touched, None])))
    assert "PartitionFilters: [(p#" in plan and " IN (" in plan and "isnull(p#" in plan


def test_no_registered_query_has_a_red_flag(spark):
    """Scale rules as a check: no cartesian product, nested-loop join, Python
    evaluation, unpartitioned window or round-robin exchange in any registered
    query, and no exchange to a single partition but under a limit or of the
    one row per task of a whole table's sums."""
    import __spark_entry__ as E
    from meteoframe import registry
    from tools.plan_audit import summarize
    flagged = {}
    queries = E.queries()
    for name in registry.all_queries():
        plan = _plan(queries[name](spark, SF))
        flags = summarize(plan).get("flags", [])
        flags += ["round robin"] * ("RoundRobinPartitioning" in plan)
        flags += ["single partition"] * ("SinglePartition" in plan and "GlobalLimit" not in plan and "Keys: []" not in plan)
        if flags:
            flagged[name] = flags
    assert flagged == {}


def test_each_line_is_split_once(spark, tmp_dir):
    from pyspark.sql import functions as F
    from meteoframe.sources import text
    path = f"{tmp_dir}/lines_{uuid.uuid4().hex[:6]}"
    spark.range(10).select(F.lit("1 2 3 4 5 6").alias("value")).write.text(path)
    lines = text.read_lines(spark, path)
    for parser in (text.parse_dust, text.parse_daily_mean, text.parse_observations, text.parse_stations):
        df = parser(lines)
        physical = df._jdf.queryExecution().executedPlan().toString()
        assert physical.count("split(") == 1, parser.__name__
        _clean(_plan(df))


def test_values_without_a_sign_are_not_parsed_for_codes(spark, tmp_dir):
    from meteoframe.functions.numeric import sentinel_to_null
    rows = spark.createDataFrame([(v,) for v in (" -9", "-9.0", "-99", "9", "", None, "1-9", "-8", "NE")], "v string")
    assert [r[0] for r in rows.select(sentinel_to_null("v", ["-9", "-99"])).collect()] == [None, None, None, "9", "", None, "1-9", "-8", "NE"]
