"""Write DataFrames out in the feeds' landed layouts.

Used to land feed files from tables (exports, fixtures, round-trip checks):
whitespace text in EUC-KR, fixed-width listings, XML and JSON responses.
Each writer is a plain distributed write - one file per output partition; rows
of one long input task are rebalanced (by adaptive execution) before they are
rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.sources import feeds


def write_lines(lines: DataFrame, path: str, encoding: str = "UTF-8",
                partitions: int | None = None, order=None, by=None) -> str:
    """Write the ``value`` column as raw lines in ``encoding``.

    With ``by`` each value of that column lands in its own folder
    ``by=<value>/`` (one landed file per fetch) and, with ``order``, lines
    keep that order inside each file.
    """
    df = lines
    if by is not None:
        df = df.repartition(partitions, by) if partitions else df.repartition(by)
    elif partitions:
        df = df.repartition(partitions)
    if order is not None:
        df = df.sortWithinPartitions(*([order] if isinstance(order, str) else order))
    value = F.col("value") if encoding.upper() == "UTF-8" else F.encode("value", encoding).cast("string")
    w = df.select(F.coalesce(value, F.lit("")).alias("value"), *([by] if by is not None else [])).write.mode("overwrite")
    if by is not None:
        w = w.partitionBy(by)
    w.text(path)
    return path


def write_fixed_width(df: DataFrame, path: str, names=K.TYPHOON_COLUMNS,
                      widths=feeds.TYPHOON_WIDTHS, header: str | None = None) -> str:
    lines = feeds.render_fixed_width(df.hint("rebalance"), names, widths)
    if header is not None:
        hdr = feeds.inline_rows(df.sparkSession, [(header,)], "value string")
        lines = hdr.unionByName(lines)
    return write_lines(lines, path)


def write_eq_xml(df: DataFrame, path: str, compression: str | None = None, rebalance: bool = True) -> str:
    """<earthqueakNoti><info>...</info></earthqueakNoti>; null tags omitted.
    ``compression`` (e.g. 'gzip') compresses each file; the reader decodes
    it from the file suffix.  Rows dealt evenly before need no ``rebalance``."""
    out = (df.hint("rebalance") if rebalance else df).select(*[F.col("reFer" if t == "ReFer" else t).alias(t) for t in K.EQ_TAGS])
    w = (out.write.mode("overwrite").format("xml").option("rowTag", "info")
         .option("rootTag", "earthqueakNoti"))
    if compression:
        w = w.option("compression", compression)
    w.save(path)
    return path


def forecast_responses(items: DataFrame, group=("nx", "ny", "fcstDate")) -> DataFrame:
    """One JSON response line per request group (a grid cell and day)."""
    item = F.struct(*[F.col(f.name) for f in feeds.FORECAST_ITEM.fields])
    g = items.groupBy(*group).agg(F.collect_list(item).alias("item"))
    body = F.struct(F.struct(F.struct(F.col("item").alias("item")).alias("items")).alias("body"))
    return g.select(F.to_json(F.struct(body.alias("response"))).alias("value"))
