"""Boilerplate lines by site-relative frequency.

A line that stands on too large a share of its host's pages is dropped from
them.  Short lines repeat by chance, so their share must be large; a longer line
on one page in a hundred is no chance.  DataFrame functions only: lines travel
as digests, counted with a partial aggregate before the shuffle; the lines to
drop are one short list per host, joined back to the pages (whose texts are
shuffled once for it where the lists are too large to broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import GAP_CHARS


SHARES = 32
LONG = 20                     # characters of a line that hardly repeats by chance
COPY = 0.75                   # a page that would lose more of its characters is a copy


def line_key(line: Column) -> Column:
    """128-bit digest of a line without blanks around it."""
    return F.unhex(F.md5(F.btrim(line, F.lit(GAP_CHARS)).cast("binary")))


def has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(GAP_CHARS))) > 0


def characters(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda n, line: n + F.length(F.btrim(line, F.lit(GAP_CHARS))))


def drop_boilerplate(df: DataFrame, text: str = "text", host: str = "source",
                     ratio: float = 0.1, long_ratio: float = 0.01, least_pages: int = 5) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text``, plus ``n_lines`` and
    ``n_dropped`` (long; columns of these names are replaced).

    A line (split at line feeds; blanks around it ignored; blank lines never
    count) is boilerplate on its host if it stands on at least ``least_pages``
    of its pages and on more than ``ratio`` of them, or ``long_ratio`` if it has
    ``LONG`` characters or more.  Each row is a page; a line that repeats within
    a page counts once.  A page that would lose more than ``COPY`` of its
    characters stays as it is: it is a copy of other pages, all of whose lines
    repeat with it, which near-duplicate removal deals with (so a page of
    nothing but boilerplate stays too).  Rows without host form one host of
    their own.  Null and empty texts stay as they are, with no lines.  All
    rows stay, repeated rows too; an empty table gives an empty table.
    """
    text_, host_ = F.col(f"`{text}`"), F.col(f"`{host}`")
    pages = df.select(F.struct(host_.alias("h")).alias("_site"), text_.alias("_text"))
    keyed = F.transform(F.filter(F.split("_text", "\n"), has_word),
                        lambda line: F.struct(line_key(line).alias("key"), (F.length(F.btrim(line, F.lit(GAP_CHARS))) >= LONG).alias("long")))
    counted = (pages.select("_site", F.explode(F.array_distinct(keyed)).alias("_line"))
               .groupBy("_site", "_line").agg(F.count(F.lit(1)).alias("_pages")).where(F.col("_pages") >= least_pages))
    totals = pages.groupBy("_site").agg(F.count(F.lit(1)).alias("_total"))
    drops = (counted.join(totals, "_site").where(F.col("_pages") > F.when(F.col("_line.long"), long_ratio).otherwise(ratio) * F.col("_total"))
             .groupBy("_site").agg(F.collect_list("_line.key").alias("_drop")))   # fewer than lines per page / ratio

    kept_columns = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    work = df.select(*[F.col(f"`{c}`") for c in kept_columns]).withColumn("_site", F.struct(host_.alias("h")))
    # lists are short and repeated per share, so that a host with a third of all pages meets them in many tasks
    drops = drops.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    work = work.withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.lit(SHARES)).cast("int")).join(drops, ["_site", "_share"], "left")

    def cleaned(lines: Column) -> Column:
        stay = F.when(F.col("_drop").isNull(), lines).otherwise(
            F.filter(lines, lambda line: ~has_word(line) | ~F.array_contains(F.col("_drop"), line_key(line))))
        worded, left = F.size(F.filter(lines, has_word)), F.size(F.filter(stay, has_word))
        kept = F.col("_drop").isNotNull() & (left < worded) & (characters(stay) >= (1 - COPY) * characters(lines))
        return F.struct(F.when(kept, F.array_join(stay, "\n")).alias("text"), worded.cast("long").alias("n"),
                        F.when(kept, worded - left).otherwise(F.lit(0)).cast("long").alias("gone"))

    # bound once as a lambda's argument, so that the split is not repeated
    work = work.withColumn("_clean", F.transform(F.array(F.split(text_, "\n")), cleaned)[0])
    out = [F.when(F.col("_clean.gone") > 0, F.col("_clean.text")).otherwise(text_).alias(c) if c == text else F.col(f"`{c}`") for c in kept_columns]
    return work.select(*out, F.coalesce("_clean.n", F.lit(0).cast("long")).alias("n_lines"),
                       F.coalesce("_clean.gone", F.lit(0).cast("long")).alias("n_dropped"))
