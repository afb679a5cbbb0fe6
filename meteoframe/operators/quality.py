"""Data-quality checks as DataFrames of offending rows (or small summaries).

Each check returns violations, so it runs distributed and the caller decides
whether to fail (``assert_empty``) - nothing is collected to inspect rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Non-null key values occurring more than once, with their count."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    not_null = F.lit(True)
    for c in cols:
        not_null = not_null & F.col(c).isNotNull()
    return (df.filter(not_null).groupBy(*cols)
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required column names absent from the schema (schema only, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def freshness(df: DataFrame, loaded_at: str, now, max_age_hours: float,
              by: Sequence[str] = ()) -> DataFrame:
    """Newest load time, its age in hours, and whether it is stale: one row,
    or one per value of ``by``."""
    newest = df.groupBy(*by).agg(F.max(loaded_at).alias("newest"))
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3.6e9
    return newest.select(*by, "newest", age.alias("age_hours"),
                         (F.coalesce(age > max_age_hours, F.lit(True))).alias("stale"))


def assert_empty(violations: DataFrame, what: str) -> None:
    if not violations.isEmpty():
        raise AssertionError(f"{what}: {violations.limit(5).collect()}")


def is_empty(df: DataFrame) -> bool:
    """Empty-input stop: reads at most one row."""
    return df.isEmpty()


def suite(df: DataFrame, unique: list[str], not_null: list[str], newest: str) -> DataFrame:
    """All checks of a table from one scan, one row per check: ``check``,
    ``failing`` (rows, or repeated keys) and ``value`` (text: the newest value).

    Rows are first summed up by key, within tasks and after the shuffle, so a
    repeated key is one row with its count; everything else is a sum or maximum
    over those.  Keys with a null part are nobody's repetition.
    """
    key = F.struct(*unique)
    by_key = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max(newest).alias("newest"),
                                            *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"null_{i}") for i, c in enumerate(not_null)])
    whole = F.lit(True)
    for c in unique:
        whole = whole & F.col(f"k.{c}").isNotNull()
    total = by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.when(whole & (F.col("n") > 1), 1)).alias("repeated"), F.max("newest").alias("newest"),
                       *[F.coalesce(F.sum(f"null_{i}"), F.lit(0)).alias(f"null_{i}") for i in range(len(not_null))])

    def line(name: str, failing: Column, value: Column | None = None) -> Column:
        return F.struct(F.lit(name).alias("check"), failing.cast("bigint").alias("failing"), (F.lit(None) if value is None else value).cast("string").alias("value"))

    lines = [line("rows", (F.col("rows") == 0).cast("int"), F.col("rows")), line("unique " + ", ".join(unique), F.col("repeated")),
             line("newest " + newest, F.col("newest").isNull().cast("int"), F.col("newest")),
             *[line("not null " + c, F.col(f"null_{i}")) for i, c in enumerate(not_null)]]
    return total.select(F.explode(F.array(*lines)).alias("c")).select("c.*")
