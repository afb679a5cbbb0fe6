"""Long-to-wide pivots with a fixed or an open column list, and key checks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.session import scratch_path


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (nulls included): key columns + n."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def cells(df: DataFrame, index: Sequence[str], column: str, value: str) -> DataFrame:
    """Per index one map from column name to value (``cells``).

    Rows are dealt by index once; a cell is an aggregate of its own (so that a
    cell repeated without end takes no memory) and the cells of an index are
    gathered from at most one row per column name.  A cell with more than one
    row, or without a column name, fails the job.
    """
    at = F.to_json(F.struct(*[F.col(i) for i in index]))
    name = F.coalesce(F.col(column), F.raise_error(F.concat(F.lit(f"{column} not listed: null at "), at)).cast("string"))
    repeated = F.raise_error(F.concat(F.lit(f"pivot key is not unique: {column}="), F.col(column), F.lit(" at "), at)).cast("string")
    one = df.repartition(*index).groupBy(*index, column).agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v"))
    cell = F.struct(name.alias("k"), F.when(F.col("_n") > 1, repeated).otherwise(F.col("_v").cast("string")).alias("v"))
    return one.groupBy(*index).agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))


def pivot_checked(df: DataFrame, index: Sequence[str], column: str, value: str,
                  values: Sequence[str]) -> DataFrame:
    """``pivot(index, column -> values)`` with a fixed column list.

    A fixed list keeps the output schema stable (a category without rows gives
    a null column).  A repeated (index, column) pair and a category that is
    not in the list both fail the job.
    """
    at = F.to_json(F.struct(*[F.col(i) for i in index]))
    strange = F.filter(F.map_keys("cells"), lambda k: ~k.isin(list(values)))
    unlisted = F.raise_error(F.concat(F.lit(f"{column} not listed: "), F.get(strange, F.lit(0)), F.lit(" at "), at)).cast("string")
    found = cells(df, index, column, value)
    first, rest = values[0], values[1:]
    checked = F.when(F.size(strange) > 0, unlisted).otherwise(F.try_element_at("cells", F.lit(first)))
    return found.select(*index, checked.alias(first), *[F.try_element_at("cells", F.lit(c)).alias(c) for c in rest])


def pivot_open(df: DataFrame, index: Sequence[str], column: str, value: str) -> DataFrame:
    """``pivot(index, column -> every name that occurs)``, columns in name order.

    The cells are aggregated and stored once; the names come from that result,
    and so do the columns.  A repeated (index, column) pair fails the job.
    """
    spark = df.sparkSession
    found = cells(df, index, column, value)
    path = scratch_path(spark, "pivot")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    names = sorted(r[0] for r in found.select(F.explode(F.map_keys("cells"))).distinct().collect())  # as many as the result has columns
    return found.select(*index, *[F.try_element_at("cells", F.lit(c)).alias(c) for c in names])
