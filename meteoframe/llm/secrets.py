"""Secret scans: fixed rules, and character Markov models compared by
log-likelihood ratio.

Two models of character pairs, one of random strings and one of ordinary
identifiers, are counted from labelled samples: strings that the fixed rules
find in the corpus and strings random by rule on one side, all other long
tokens of the corpus on the other.  A token is a secret where the ratio of the
two outweighs the prior odds.  DataFrame functions only.  The models are 128 x
128 whole numbers, so sums and verdicts do not depend on order or engine.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.llm.outliers import let

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{14,}"           # all of a run of 18 or more; in a shorter run no later start is longer
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "markov"]
LEAST_VALUE = 12                        # characters of an assigned value, and of a training token
SMOOTH = 0.5                            # added to every character's count
CHARACTERS = 66                         # that a token may hold
WEIGHT = 33                             # of the plain character frequencies, in counts, behind every character
UNIT = 1000                             # of a log ratio in the integer tables

Hits = Callable[[Column], Column]


@dataclass
class PairModel:
    """Log ratios of random to ordinary, times ``UNIT``, by 128 * previous + next
    character (previous 0 at the start)."""

    ratios: list[int]
    odds: float = math.log(1000)        # of ordinary to random before looking at the token
    least: int = 16                     # characters of a token that is judged

    @property
    def bar(self) -> int:
        return round(UNIT * self.odds)

    def score(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<int>")
        return let(codes(token), lambda c: F.aggregate(pairs(c), F.lit(0).cast("long"), lambda a, p: a + F.get(table, p)))


def token_pattern(least: int) -> str:
    return rf"[A-Za-z0-9+/_=-]{{{least},}}"


def codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.ascii(c))


def pairs(c: Column) -> Column:
    """128 * previous + next of each place in an array of character codes."""
    return F.transform(c, lambda x, i: F.coalesce(F.get(c, i - 1), F.lit(0)) * 128 + x)


def running(values: Column, combine: Callable[..., Column], neutral: int, reach: int = 1) -> Column:
    """Running sums (or other) of an array in steps that grow 16-fold: n log n
    work, and seven steps for an array of any length."""
    if reach == 16 ** 7:
        return values
    return let(values, lambda v: F.when(F.size(v) <= reach, v).otherwise(running(
        F.transform(v, lambda x, i: combine(x, *[F.coalesce(F.get(v, i - F.lit(k * reach)), F.lit(neutral)) for k in range(1, 16)])),
        combine, neutral, reach * 16)))


def total(*parts: Column) -> Column:
    return reduce(Column.__add__, parts)


def places(text: Column, pattern: str, kind: int, fits: Column | None = None) -> Column:
    """Matches of ``pattern`` as ``start, kind, end`` in code points; ``fits``
    holds one boolean per match, a match without is dropped."""
    def spans(hits: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        lengths = F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda z: F.length(z["gap"]) + F.coalesce(F.length(z["hit"]), F.lit(0)))
        ends = running(lengths, total, 0)
        found = let(ends, lambda e: F.transform(hits, lambda h, i: F.struct((e[i] - F.length(h)).alias("start"), F.lit(kind).alias("kind"), e[i].alias("end"))))
        if fits is not None:
            found = let(fits, lambda ok: F.filter(found, lambda _, i: ok[i]))
        return found

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


NO_SPANS = "array<struct<start:int,kind:int,end:int>>"


def base_spans(text: Column) -> Column:
    """The fixed rules' spans by start, then kind."""
    none = F.array().cast(NO_SPANS)
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= LEAST_VALUE)
    return F.sort_array(F.concat(F.when(F.regexp_like(text, F.lit(ASSIGN_HINT)), places(text, ASSIGN, 0, values)).otherwise(none),
                                 F.when(F.contains(text, F.lit("AKIA")), places(text, ACCESS, 1)).otherwise(none),
                                 F.when(F.regexp_like(text, F.lit(HEX)), places(text, HEX, 2)).otherwise(none)))


def apart(found: Column, base: Column) -> Column:
    """Spans of ``found`` that overlap none of ``base``."""
    far = 2147483647

    def kept(s: Column) -> Column:
        before = running(F.transform(s, lambda x: F.when(x["kind"] < 3, x["end"]).otherwise(0)), F.greatest, 0)
        after = F.reverse(running(F.reverse(F.transform(s, lambda x: F.when(x["kind"] < 3, x["start"]).otherwise(far))), F.least, far))
        return let(before, lambda b: let(after, lambda a: F.filter(s, lambda x, i: (x["kind"] == 3) & (b[i] <= x["start"]) & (a[i] >= x["end"]))))

    return F.when(F.size(base) == 0, found).when(F.size(found) == 0, found).otherwise(let(F.sort_array(F.concat(found, base)), kept))


def labelled_tokens(df: DataFrame, text: str) -> DataFrame:
    """Distinct long tokens of all texts with ``random`` true for what the fixed
    rules find.  A token that a rule finds anything in is left out of the
    ordinary ones."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    values = F.when(F.regexp_like(t, F.lit(ASSIGN_HINT)), F.filter(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= LEAST_VALUE))
    keys = F.when(F.contains(t, F.lit("AKIA")), F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)))
    runs = F.when(F.regexp_like(t, F.lit(HEX)), F.regexp_extract_all(t, F.lit(HEX), F.lit(0)))
    words = F.regexp_extract_all(t, F.lit(token_pattern(LEAST_VALUE)), F.lit(0))
    none = F.array().cast("array<string>")
    tagged = F.concat(F.transform(F.concat(*[F.coalesce(c, none) for c in (values, keys, runs)]), lambda w: F.struct(w.alias("token"), F.lit(True).alias("random"))),
                      F.transform(words, lambda w: F.struct(w.alias("token"), F.lit(False).alias("random"))))
    tokens = (df.select(F.explode(F.array_distinct(tagged)).alias("w")).select("w.*")
              .groupBy("token").agg(F.max("random").alias("random")))
    return tokens.where(F.col("random") | ~F.regexp_like("token", F.lit(f"{ACCESS}|{HEX}|{ASSIGN}")))


def random_by_rule(spark: SparkSession, rows: int = 2000) -> DataFrame:
    """Labelled random strings in the alphabets that keys come in: hexadecimal,
    base64 and its form for URLs, capitals with digits, letters with digits."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    plain = F.translate(F.base64(F.unhex(digest)), "=", "")
    return spark.range(rows).select(F.explode(F.array(F.substring(digest, 1, 40), plain, F.translate(plain, "+/", "-_"), F.upper(F.translate(plain, "+/", "")),
                                                      F.translate(plain, "+/", ""))).alias("token"), F.lit(True).alias("random"))


def learn(df: DataFrame, text: str = "text", samples: DataFrame | None = None, **model) -> PairModel:
    """The two models' ratios, from all texts and ``samples`` (``token``,
    ``random``; by default ``random_by_rule``).

    Each distinct token counts once, so copies have no weight.  Null and empty
    texts teach nothing; of an empty table the samples alone teach.  The driver
    gets at most 2 * 128 * 66 counts.
    """
    samples = random_by_rule(df.sparkSession) if samples is None else samples
    tokens = labelled_tokens(df, text).unionByName(samples.select("token", "random"))
    counted = (tokens.withColumn("c", codes(F.col("token"))).select("random", F.explode(pairs(F.col("c"))).alias("pair"))
               .groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {(r.random, r.pair): r.n for r in counted}
    before, after = Counter(), Counter()
    for (kind, pair), n in counts.items():
        before[kind, pair // 128] += n
        after[kind, pair % 128] += n
        after[kind] += n

    def log_p(kind: bool, pair: int) -> float:
        plain = (after[kind, pair % 128] + SMOOTH) / (after[kind] + SMOOTH * CHARACTERS)
        return math.log((counts.get((kind, pair), 0) + WEIGHT * plain) / (before[kind, pair // 128] + WEIGHT))

    return PairModel([round(UNIT * (log_p(True, p) - log_p(False, p))) for p in range(128 * 128)], **model)


def find_secrets(df: DataFrame, model: PairModel, text: str = "text") -> DataFrame:
    """``df`` plus ``secrets``: spans as ``start, kind, end`` in code points (kind:
    the place in ``KINDS``), by start, then kind.

    Spans of the fixed rules always stay; a token of ``model.least`` or more
    characters that overlaps none of them is added where the model's ratio
    passes the odds.  Whole texts, one row out per row in; null and empty texts
    have no spans; a column ``secrets`` is replaced.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    pattern = token_pattern(model.least)
    random = let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda hits: F.transform(hits, lambda w: model.score(w) > F.lit(model.bar)))
    found = let(random, lambda r: F.when(F.exists(r, lambda x: x), places(t, pattern, 3, r)).otherwise(F.array().cast(NO_SPANS)))
    return df.withColumn("secrets", let(base_spans(t), lambda base: F.sort_array(F.concat(base, apart(found, base)))))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
