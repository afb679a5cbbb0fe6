"""Table writes and streams: rewrite safety, idempotence, partitions, restarts."""

import os
import uuid

from pyspark.sql import functions as F

from meteoframe import sinks
from meteoframe.streaming import jobs


def _db(spark, tmp_dir):
    name = "t_" + uuid.uuid4().hex[:8]
    sinks.ensure_namespace(spark, name, tmp_dir + "/" + name)
    return name


def test_upsert_table_twice_equals_once(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    t = f"{db}.score"
    sinks.create_if_absent(spark, t, "region_code string, date string, score int", location=tmp_dir + "/score")
    sinks.create_if_absent(spark, t, "region_code string, date string, score int", location=tmp_dir + "/score")
    sinks.append(spark.createDataFrame([("108", "2025-01-13", 70), ("159", "2025-01-13", 50)],
                                       "region_code string, date string, score int"), t)
    src = spark.createDataFrame([("108", "2025-01-13", 80), ("143", "2025-01-13", 60)],
                                "region_code string, date string, score int")
    sinks.upsert_table(spark, t, src, ["region_code", "date"])
    once = sorted(tuple(r) for r in spark.table(t).collect())
    sinks.upsert_table(spark, t, src, ["region_code", "date"])
    assert sorted(tuple(r) for r in spark.table(t).collect()) == once == [
        ("108", "2025-01-13", 80), ("143", "2025-01-13", 60), ("159", "2025-01-13", 50)]


def test_partitioned_upsert_and_day_replace(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    t = f"{db}.eq"
    sinks.create_if_absent(spark, t, "id string, v int, day string", location=tmp_dir + "/eq",
                           partitioned_by=["day"])
    sinks.append(spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d1"), ("c", 3, "d2")],
                                       "id string, v int, day string"), t)
    sinks.upsert_table(spark, t, spark.createDataFrame([("a", 10, "d1"), ("z", 9, "d1")],
                                                       "id string, v int, day string"),
                       ["day", "id"], partition_col="day")
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [
        ("a", 10, "d1"), ("b", 2, "d1"), ("c", 3, "d2"), ("z", 9, "d1")]
    # replacing a day with no rows empties it, other days stay
    empty = spark.createDataFrame([], "id string, v int, day string")
    sinks.replace_partition(spark, t, empty, "day", "d1")
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [("c", 3, "d2")]
    new = spark.createDataFrame([("n", 5, "d1")], "id string, v int, day string")
    sinks.replace_partition(spark, t, new, "day", "d1")
    sinks.replace_partition(spark, t, new, "day", "d1")
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [("c", 3, "d2"), ("n", 5, "d1")]


def test_retention_and_overwrite(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    t = f"{db}.fc"
    df = spark.createDataFrame([("20240101",), ("20240120",), (None,)], "FCST_DATE string")
    sinks.overwrite(df, t, path=tmp_dir + "/fc")
    sinks.retain_rows(spark, t, ~(F.col("FCST_DATE") < "20240115"))
    assert sorted(str(r[0]) for r in spark.table(t).collect()) == ["20240120", "None"]


def test_dated_and_latest_copies(spark, tmp_dir):
    df = spark.createDataFrame([("108", None), ("109", "x")], "STN string, v string")
    dated, latest = sinks.write_dated_and_latest(df, tmp_dir + "/out", "2024-06")
    a = sorted(tuple(r) for r in spark.read.option("header", True).csv(dated).collect())
    b = sorted(tuple(r) for r in spark.read.option("header", True).csv(latest).collect())
    assert a == b == [("108", None), ("109", "x")]


def test_stream_load_once_survives_restart(spark, tmp_dir):
    landing, sink, ckpt = tmp_dir + "/landing", tmp_dir + "/sink", tmp_dir + "/ckpt"
    os.makedirs(landing)
    with open(landing + "/h1.txt", "w") as f:
        f.write("# c\n20240101 org1 108 12\n")
    for _ in range(2):  # second run: same file, nothing new
        jobs.run_available(jobs.text_lines_stream(spark, landing), sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    with open(landing + "/h2.txt", "w") as f:
        f.write("20240101 org1 109 13\n")
    jobs.run_available(jobs.text_lines_stream(spark, landing), sink, ckpt)  # restart from checkpoint
    assert sorted(r.value for r in spark.read.parquet(sink).collect()) == [
        "# c", "20240101 org1 108 12", "20240101 org1 109 13"]


def test_namespace_switch(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    prev = spark.catalog.currentDatabase()
    try:
        sinks.use_namespace(spark, db)
        assert spark.catalog.currentDatabase() == db
    finally:
        sinks.use_namespace(spark, prev)


def test_partition_limited_retention(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    t = f"{db}.fc"
    sinks.create_if_absent(spark, t, "FCST_DATE string, v int, BASE_DATE string", partitioned_by=["BASE_DATE"])
    sinks.append(spark.createDataFrame(
        [("20240101", 1, "20240101"), ("20240102", 2, "20240101"),     # whole partition expires
         ("20240108", 3, "20240108"), ("20240120", 4, "20240108"),     # half of it expires
         ("20240120", 5, "20240115")],                                 # untouched partition
        "FCST_DATE string, v int, BASE_DATE string"), t)
    sinks.retain_rows(spark, t, ~(F.col("FCST_DATE") < "20240110"), "BASE_DATE", F.col("BASE_DATE") < "20240110")
    assert sorted(r.v for r in spark.table(t).collect()) == [4, 5]
    assert sorted(r.partition for r in spark.sql(f"SHOW PARTITIONS {t}").collect() if
                  spark.table(t).filter(F.col("BASE_DATE") == r.partition.split("=")[1]).count()) == [
        "BASE_DATE=20240108", "BASE_DATE=20240115"]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_job_killed_before_publication_leaves_the_old_rows(spark, tmp_dir, monkeypatch):
    db = _db(spark, tmp_dir)
    t, u = f"{db}.eq", f"{db}.flat"
    sinks.create_if_absent(spark, t, "id string, v int, day string", tmp_dir + "/eq", ["day"])
    sinks.create_if_absent(spark, u, "id string, v int", tmp_dir + "/flat")
    sinks.append(spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d1"), ("c", 3, "d2"), ("n", 4, None)], "id string, v int, day string"), t)
    sinks.append(spark.createDataFrame([("a", 1)], "id string, v int"), u)
    before, flat = _rows(spark.table(t)), _rows(spark.table(u))
    source = spark.createDataFrame([("a", 10, "d1"), ("z", 9, None), ("q", 7, "d3")], "id string, v int, day string")
    real = sinks.publish

    def killed(*a, **k):
        raise RuntimeError("killed")
    monkeypatch.setattr(sinks, "publish", killed)
    for job in (lambda: sinks.upsert_table(spark, t, source, ["id", "day"], partition_col="day"),
                lambda: sinks.replace_rows(spark, t, source, F.col("day") == "d1", "day", ["d1"]),
                lambda: sinks.retain_rows(spark, t, F.col("v") > 2, "day", F.col("day") < "d2"),
                lambda: sinks.overwrite(spark.createDataFrame([("x", 5)], "id string, v int"), u)):
        try:
            job()
            raise AssertionError("not killed")
        except RuntimeError:
            pass
        assert _rows(spark.table(t)) == before and _rows(spark.table(u)) == flat
    monkeypatch.setattr(sinks, "publish", real)
    sinks.upsert_table(spark, t, source, ["id", "day"], partition_col="day")
    assert _rows(spark.table(t)) == sorted([("a", 10, "d1"), ("b", 2, "d1"), ("c", 3, "d2"), ("n", 4, None), ("z", 9, None), ("q", 7, "d3")], key=str)
    sinks.replace_rows(spark, t, source.limit(0), F.col("day") == "d1", "day", ["d1"])
    sinks.overwrite(spark.createDataFrame([("x", 5)], "id string, v int"), u)
    after = _rows(spark.table(t))
    assert after == sorted([("c", 3, "d2"), ("n", 4, None), ("z", 9, None), ("q", 7, "d3")], key=str) and _rows(spark.table(u)) == [("x", 5)]
    files = lambda: sum(len([n for n in names if n.endswith(".parquet")]) for _, _, names in os.walk(tmp_dir))
    held = files()
    assert sinks.remove_old_versions(spark, t) == 0                     # all young
    assert sinks.remove_old_versions(spark, t, 0) + sinks.remove_old_versions(spark, u, 0) > 0 and files() < held
    assert _rows(spark.table(t)) == after and _rows(spark.table(u)) == [("x", 5)]


def test_partitions_get_few_files_and_hot_ones_are_split(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    t = f"{db}.days"
    sinks.create_if_absent(spark, t, "id bigint, day string", tmp_dir + "/days", ["day"])
    rows = spark.range(0, 20000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("day"))
    sinks.append(rows, t)
    per = {}
    for f in spark.table(t).inputFiles():
        per[f.split("/")[-2]] = per.get(f.split("/")[-2], 0) + 1
    assert len(per) == 51 and max(per.values()) == 1 and spark.table(t).count() == 20000
    plan = sinks.clustered(rows, ["day"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [day" in plan


def test_merge_by_a_derived_partition_reads_the_target_once(spark, tmp_dir):
    import pytest
    db = _db(spark, tmp_dir)
    t = f"{db}.ty"
    sinks.create_if_absent(spark, t, "ts string, v int, month string", tmp_dir + "/ty", ["month"])
    sinks.append(spark.createDataFrame([("20240101", 1, "202401"), ("20240201", 2, "202402"), (None, 3, None)], "ts string, v int, month string"), t)
    source = spark.createDataFrame([("20240101", 10, "202401"), ("20240105", 11, "202401"), (None, 12, None)], "ts string, v int, month string")
    with pytest.raises(ValueError):
        sinks.upsert_table(spark, t, source, ["ts"], partition_col="month")
    with pytest.raises(ValueError):
        sinks.upsert_table(spark, t, source, ["ts"], partition_col="month", derived_from=["v"])
    from meteoframe.operators.merge import update_matched
    target = spark.table(t).filter(sinks.in_partitions("month", sinks.partition_values(source, "month")))
    from tests.test_plans import _plan
    plan = _plan(update_matched(target, source, ["ts"]))
    assert plan.count(") Scan parquet") == 1
    assert "month" in next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    sinks.upsert_table(spark, t, source, ["ts"], partition_col="month", derived_from=["ts"])
    assert sorted(r.v for r in spark.table(t).collect()) == [2, 3, 10, 11, 12]
    untouched = [f for f in spark.table(t).inputFiles() if "month=202402" in f]
    assert untouched and all(sinks.VERSIONS not in f for f in untouched)


def test_late_rows_are_counted_and_state_shrinks(spark, tmp_dir):
    from meteoframe import tasks
    landing, out, ckpt = (f"{tmp_dir}/{n}" for n in ("land", "out", "ckpt"))
    os.makedirs(landing)
    counts = []
    for n, lines in enumerate((["202401010100 O %d 5" % s for s in range(50)], ["202401010100 O 3 9", "202401020100 O 1 7"],
                               ["202401030100 O 1 8"], ["202401010100 O 77 1", "202401030100 O 1 8", "202401030200 O 2 8", "bad O 1 1"])):
        with open(f"{landing}/h{n}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        counts.append(tasks.stream_hourly_dust(spark, landing, out, ckpt))
    assert [c["rows"] for c in counts] == [50, 2, 1, 4]
    assert [c["late"] for c in counts] == [0, 0, 0, 1]              # station 77, two days after its hour
    assert counts[0]["state"] == 50 and counts[-1]["state"] <= 3
    got = sorted((r.DATE, r.STN) for r in spark.read.parquet(out).collect())
    assert len(got) == 53 and ("202401010100", "77") not in got
    assert spark.read.parquet(out + "_rejects").count() == 1
    held = [d for d, _, names in os.walk(ckpt) if any(x.endswith(".zip") or x.endswith(".sst") for x in names)]
    assert held                                                      # RocksDB's own files
