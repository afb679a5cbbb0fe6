"""Inferred edges, load ledger, incremental region tables, open pivot."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from meteoframe import sinks, tasks
from meteoframe.operators import reshape
from meteoframe.plans import quake
from meteoframe.sources import feeds, standins as S

SF = "/root/testdata/sf0.001"


def _db(spark, tmp_dir):
    name = "l_" + uuid.uuid4().hex[:8]
    sinks.ensure_namespace(spark, name, tmp_dir + "/" + name)
    return name


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)


def test_edges_are_the_blanks_that_all_lines_share(spark):
    wide = "x" * 130
    lines = ["# a comment without blanks at all", "", "ab   12 " + wide, "   c  3\t" + wide[:70], "  한글 4  y"]
    assert feeds.infer_edges(_lines(spark, lines)) == [(1, 4), (6, 2), (9, 130)]
    rows = feeds.parse_inferred_width(_lines(spark, lines), ["a", "b", "c"]).collect()
    assert sorted((r.a, r.b, r.c) for r in rows) == [("ab", "12", wide), ("c", "3", wide[:70]), ("한글", "4", "y")]
    with pytest.raises(ValueError):
        feeds.parse_inferred_width(_lines(spark, lines), ["a", "b"])
    assert feeds.infer_edges(_lines(spark, ["# only", " "])) == []
    assert feeds.parse_inferred_width(_lines(spark, ["#"]), ["a", "b"]).collect() == []


def test_each_file_loads_once_and_a_killed_load_leaves_nothing(spark, tmp_dir, monkeypatch):
    db = _db(spark, tmp_dir)
    table, ledger, landing = f"{db}.t", f"{db}.ledger", tmp_dir + "/landing"
    os.makedirs(landing + "/deep")

    def put(name, text):
        with open(f"{landing}/{name}", "w") as f:
            f.write(text)

    def load():
        return sinks.load_once(spark, landing, table, ledger, lambda paths: spark.read.text(paths))

    def held():
        spark.catalog.refreshTable(table)
        return sorted(r.value for r in spark.table(table).collect())

    put("a.txt", "a1\na2\n")
    put("deep/b c.txt", "b1\n")
    assert load() == 2 and load() == 0 and held() == ["a1", "a2", "b1"]
    put("c.txt", "c1\n")
    real = sinks.append

    def killed(df, name):
        raise RuntimeError("killed")
    monkeypatch.setattr(sinks, "append", killed)
    with pytest.raises(RuntimeError):
        load()
    monkeypatch.setattr(sinks, "append", real)
    assert load() == 1 and held() == ["a1", "a2", "b1", "c1"]          # not twice
    time.sleep(1.1)
    put("a.txt", "a3\n")
    assert load() == 1 and held() == ["a1", "a2", "a3", "b1", "c1"] and load() == 0


def test_region_tables_follow_from_the_touched_month_alone(spark, tmp_dir):
    db = _db(spark, tmp_dir)
    raw_t, states, dom, fgn = (f"{db}.{n}" for n in ("raw", "states", "dom", "fgn"))
    raw = quake.with_month(S.raw_eq_world(spark, SF))
    sinks.create_if_absent(spark, raw_t, sinks.ddl(raw), tmp_dir + "/raw", [quake.MONTH])
    sinks.append(raw, raw_t)
    tasks.refresh_eq_regions(spark, raw_t, states, dom, fgn)

    def check():
        now = spark.table(raw_t)
        for name, want in ((dom, quake.region_latest(quake.domestic(now))), (fgn, quake.region_max(quake.foreign(now)))):
            assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, want.collect()))

    check()
    before = {f for f in spark.table(states).inputFiles() if "199808" not in f}
    month = spark.table(raw_t).filter(F.col(quake.MONTH) == "199808")
    sinks.replace_rows(spark, raw_t, month.filter("eqLn = '1'").withColumn("eqPt", F.lit("New place")), F.col(quake.MONTH) == "199808", quake.MONTH, ["199808"])
    tasks.refresh_eq_regions(spark, raw_t, states, dom, fgn, months=["199808"])
    check()
    assert {f for f in spark.table(states).inputFiles() if "199808" not in f} == before
    sinks.replace_rows(spark, raw_t, month.limit(0), F.col(quake.MONTH) == "199808", quake.MONTH, ["199808"])
    tasks.refresh_eq_regions(spark, raw_t, states, dom, fgn, months=["199808"])
    check()


def test_open_pivot_has_a_column_for_every_name(spark):
    long = spark.createDataFrame([(1, "TMP", "5"), (1, "ZZZ", None), (2, "new", "7")], "i int, c string, v string")
    w = reshape.pivot_open(long, ["i"], "c", "v")
    assert w.columns == ["i", "TMP", "ZZZ", "new"] and sorted(map(tuple, w.collect())) == [(1, "5", None, None), (2, None, None, "7")]
    for bad in ((1, "TMP", "6"), (3, None, "1")):
        with pytest.raises(Exception):
            reshape.pivot_open(long.unionByName(spark.createDataFrame([bad], long.schema)), ["i"], "c", "v").collect()
    assert reshape.pivot_open(long.limit(0), ["i"], "c", "v").collect() == []
