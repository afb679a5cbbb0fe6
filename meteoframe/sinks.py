"""Table writes: create-if-absent, append, overwrite, keyed upsert, day
replacement, retention, CSV exports, dated + latest copies, namespaces.

A change is written to a new *version folder* under the table's home and then
published by pointing the table, or each changed partition, at it (``ALTER
TABLE ... SET LOCATION``).  Until then readers see the old rows, a job that
dies leaves them as they were, and no second copy of the rows is needed to cut
the plan off from the files it replaces.  Publication is atomic per partition,
or for the whole table where it has none.  ``remove_old_versions`` deletes what
is no longer, or was never, published.

Every write to a partitioned table is rebalanced by the partition column, so a
partition gets few files and a hot one is split over tasks.
"""

from __future__ import annotations

import time
import uuid
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.operators.merge import dedupe_source, insert_unmatched, retain, update_matched
from meteoframe.session import checkpoint_dir, scratch_path


# ------------------------------------------------------------ namespaces
def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def use_namespace(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


# ------------------------------------------------------------ DDL / loads
def ddl(df: DataFrame) -> str:
    """Columns of a table that holds these rows."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def create_if_absent(spark: SparkSession, table: str, ddl: str, location: str | None = None,
                     partitioned_by: Sequence[str] = ()) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet{part}{loc}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def clustered(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows dealt by partition column; adaptive execution joins small shares and
    splits large ones."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def append(df: DataFrame, table: str) -> None:
    """INSERT rows (by name).  Re-running appends again: use upsert for idempotence."""
    spark = df.sparkSession
    clustered(df.select(*spark.table(table).columns), partition_columns(spark, table)).write.insertInto(table)


def overwrite(df: DataFrame, table: str, path: str | None = None) -> None:
    """CREATE OR REPLACE TABLE ... AS: full rebuild.  A table of the same columns
    is rebuilt in a new version and published at once; another is replaced."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and not partition_columns(spark, table) and \
            [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
        version = new_version(spark, table)
        write_version(df, table, version)
        publish(spark, table, version)
        return
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def create_view(df: DataFrame, name: str) -> None:
    """A stored query of this session: stays lazy, re-evaluated on read."""
    df.createOrReplaceTempView(name)


def create_catalog_view(spark: SparkSession, name: str, table: str, condition: str) -> None:
    """A stored query kept in the catalog: the rows of ``table`` for which the
    SQL ``condition`` holds, re-evaluated on read by any session."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table} WHERE {condition}")


def partition_values(df: DataFrame, col: str) -> list:
    """Distinct values of a partition column: a list as short as the list of
    partitions that the rows touch."""
    return [r[0] for r in df.select(col).distinct().collect()]


def in_partitions(col: str, values: Sequence) -> Column:
    """Predicate on literals, so that the scan prunes its partitions."""
    known = [v for v in values if v is not None]
    one = F.col(col).isin(known) if known else F.lit(False)
    return one | F.col(col).isNull() if len(known) < len(values) else one


# -------------------------------------------------------------- versions
VERSIONS = "_versions"


def location(spark: SparkSession, table: str) -> str:
    """The folder the table points at now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1].data_type.rstrip("/")


def home(spark: SparkSession, table: str) -> str:
    """The folder that holds all versions of the table."""
    return location(spark, table).split(f"/{VERSIONS}/")[0]


def new_version(spark: SparkSession, table: str) -> str:
    return f"{home(spark, table)}/{VERSIONS}/{uuid.uuid4().hex}"


def write_version(rows: DataFrame, table: str, version: str) -> None:
    """Add rows, cast to the table's types, to an unpublished version."""
    spark = rows.sparkSession
    parts = partition_columns(spark, table)
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.table(table).schema.fields])
    w = clustered(typed, parts).write.mode("append")
    (w.partitionBy(*parts) if parts else w).parquet(version)


def read_version(spark: SparkSession, table: str, version: str) -> DataFrame:
    return spark.read.schema(spark.table(table).schema).parquet(version)


def _sql_value(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(spark: SparkSession, table: str, version: str, partition_col: str | None = None, scope: Sequence = ()) -> None:
    """Point the table at a version; or, with ``partition_col``, each partition
    that the version holds, while the other partitions of ``scope`` go."""
    if partition_col is None:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    else:
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
        held = read_version(spark, table, version).select(F.col(partition_col).alias("value"), F.url_decode(folder).alias("folder")).distinct().collect()
        known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        specs = [(r, f"PARTITION (`{partition_col}` = {_sql_value(r.value)})", r.folder.rsplit("/", 1)[-1] in known) for r in held]
        new = [f"{spec} LOCATION '{r.folder}'" for r, spec, old in specs if not old]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD {' '.join(new)}")
        for r, spec, old in specs:
            if old:
                spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{r.folder}'")
        for value in set(scope) - {r.value for r in held}:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{partition_col}` = {_sql_value(value)})")
    spark.catalog.refreshTable(table)


def remove_old_versions(spark: SparkSession, table: str, keep_hours: float = 24) -> int:
    """Delete files under the table's home that it does not point at and that are
    older than ``keep_hours`` (long enough for running readers and unpublished
    writes).  Returns how many."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(home(spark, table))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    live = {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toUri().getPath() for f in spark.table(table).inputFiles()}
    before, gone, found = (time.time() - 3600 * keep_hours) * 1000, 0, files.listFiles(root, True)
    while found.hasNext():
        f = found.next()
        if f.getPath().toUri().getPath() not in live and f.getModificationTime() <= before:
            gone += files.delete(f.getPath(), False)
    return gone


# --------------------------------------------------------------- changes
def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
                 order: Sequence[tuple] = (), partition_col: str | None = None, derived_from: Sequence[str] = ()) -> None:
    """MERGE source INTO table ON keys (rows as in ``operators.merge.upsert_frame``).

    With ``partition_col`` only the partitions that the source names are read
    and rewritten.  It must be one of the keys, or a column that follows from
    keys (``derived_from``, filled in the source by the caller): equal keys
    then lie in the same partition.

    The source is stored once, the target read once: target rows, changed or
    not, go to a new version; the source rows whose keys that version does not
    hold follow; then it is published.
    """
    if partition_col is not None and partition_col not in keys and not (derived_from and set(derived_from) <= set(keys)):
        raise ValueError("partition column must be one of the merge keys or follow from them")
    target = spark.table(table)
    cols = target.columns
    staged = scratch_path(spark, "merge-source")
    dedupe_source(source.select(*cols), keys, order).write.parquet(staged)
    source = spark.read.schema(target.schema).parquet(staged)
    scope: list = []
    if partition_col is not None:
        scope = partition_values(source, partition_col)
        target = target.filter(in_partitions(partition_col, scope))
    version = new_version(spark, table)
    write_version(update_matched(target, source, keys), table, version)
    write_version(insert_unmatched(read_version(spark, table, version), source, keys), table, version)
    publish(spark, table, version, partition_col, scope)


def replace_rows(spark: SparkSession, table: str, new_rows: DataFrame, in_range: Column,
                 partition_col: str | None = None, in_scope: Sequence = ()) -> None:
    """DELETE WHERE in_range; then INSERT new_rows - as one published version.

    For a table partitioned by ``partition_col``, ``in_scope`` lists the
    partitions that can hold rows of the range: only those, and the ones that
    ``new_rows`` touch, are read and rewritten.  The new rows are written
    first, so they are computed once; the kept rows follow them.
    """
    version = new_version(spark, table)
    write_version(new_rows, table, version)
    target, touched = spark.table(table), list(in_scope)
    if partition_col is not None:
        touched = list({*in_scope, *partition_values(read_version(spark, table, version), partition_col)})
        target = target.filter(in_partitions(partition_col, touched))
    write_version(target.filter(~F.coalesce(in_range, F.lit(False))), table, version)
    publish(spark, table, version, partition_col, touched)


def replace_partition(spark: SparkSession, table: str, new_rows: DataFrame,
                      partition_col: str, value) -> None:
    """Replace one partition (e.g. one event day) with the rows of ``new_rows``
    that belong to it; without any the partition goes.  Other partitions are
    not touched and rerunning gives the same table.  The value may be of any
    type, or null."""
    kind = spark.table(table).schema[partition_col].dataType
    version = new_version(spark, table)
    write_version(new_rows.filter(F.col(partition_col).cast(kind).eqNullSafe(F.lit(value).cast(kind))), table, version)
    publish(spark, table, version, partition_col, [value])


def retain_rows(spark: SparkSession, table: str, keep: Column, partition_col: str | None = None,
                in_scope: Column | None = None) -> None:
    """DELETE WHERE NOT keep (rows whose predicate is null are kept).

    For a table partitioned by ``partition_col``, ``in_scope`` (a predicate
    on that column) names the only partitions that can hold rows to delete:
    just those are read and rewritten, and any that end up empty go.
    """
    target, scope = spark.table(table), []
    if partition_col is None or in_scope is None:
        partition_col = None if not partition_columns(spark, table) else partition_columns(spark, table)[0]
    else:
        target = target.filter(in_scope)
    if partition_col is not None:
        scope = partition_values(target, partition_col)
        if not scope:
            return
    version = new_version(spark, table)
    write_version(retain(target, keep), table, version)
    publish(spark, table, version, partition_col, scope)


# ----------------------------------------------------------- load ledger
LOAD = "load_id"
LEDGER_DDL = "path string, length bigint, modificationTime timestamp, load_id string"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """path, length, modificationTime of every landed file; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
            .select("path", "length", "modificationTime"))


def load_once(spark: SparkSession, landing: str, table: str, ledger: str,
              read: Callable[[list[str]], DataFrame], location: str | None = None) -> int:
    """Append the files of ``landing`` that ``ledger`` does not name to ``table``;
    returns how many.  A file counts as loaded by path, length and modification
    time, so a changed file loads again and a second run loads nothing.

    ``read`` makes rows of a list of paths.  The table is partitioned by load:
    rows are written first and the ledger's entries last, in one write; a load
    that died in between has no entry, and its partition goes at the next run,
    so no row is lost or held twice.  Runs of one ledger must not overlap.
    """
    if spark.catalog.tableExists(table):
        known = {r[0] for r in spark.table(ledger).select(LOAD).distinct().collect()}
        for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
            load = r.partition.split("=", 1)[1]
            if load not in known:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD} = {_sql_value(load)})")
    create_if_absent(spark, ledger, LEDGER_DDL, f"{location}_ledger" if location else None)
    fresh = landed_files(spark, landing).join(spark.table(ledger).select("path", "length", "modificationTime"), ["path", "length", "modificationTime"], "left_anti")
    entries = fresh.collect()                              # names of the files of one load
    if not entries:
        return 0
    load = uuid.uuid4().hex
    rows = read([r.path for r in entries]).withColumn(LOAD, F.lit(load))
    create_if_absent(spark, table, ddl(rows), location, [LOAD])
    version = new_version(spark, table)
    write_version(rows, table, version)
    publish(spark, table, version, LOAD, [load])
    append(spark.createDataFrame([(*r, load) for r in entries], LEDGER_DDL).coalesce(1), ledger)
    spark.catalog.refreshTable(ledger)
    return len(entries)


# -------------------------------------------------------------- exports
def write_csv(df: DataFrame, path: str, header: bool = True, bom: bool = False) -> str:
    """CSV with header; nulls are written as nothing and empty text as "",
    quotes inside values are doubled, blanks are kept.  ``bom``: each file
    starts with a byte order mark, as spreadsheets want it; it is part of the
    header's first name, so a header is needed."""
    if bom:
        if not header:
            raise ValueError("a byte order mark needs a header")
        first = df.columns[0]
        df = df.withColumnRenamed(first, "\ufeff" + first)
    (df.write.mode("overwrite").option("header", header).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("nullValue", "").option("emptyValue", '""').csv(path))
    return path


def write_dated_and_latest(df: DataFrame, base: str, stamp: str, bom: bool = False) -> tuple[str, str]:
    """Same contents to ``base/dated=<stamp>`` and ``base/latest``, computed
    once."""
    checkpoint_dir(df.sparkSession)
    once = df.checkpoint()
    return (write_csv(once, f"{base.rstrip('/')}/dated={stamp}", bom=bom),
            write_csv(once, f"{base.rstrip('/')}/latest", bom=bom))
