"""Quality rules: base counts per text, and robust multivariate outliers.

Per language and source, a minimum-covariance-determinant estimate of centre
and scatter is fitted to a few transformed statistics; a document far from its
group's centre in Mahalanobis distance is rejected.  DataFrame functions only.

The estimate takes concentration steps: keep the three quarters of a group
nearest to the present centre, compute their mean and covariance, repeat.
Which rows are nearest is read off a histogram of distances with fixed bins, in
which each bin also carries its rows' moments: one aggregation of bounded size
per group and step, the same result in any order of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteoframe.llm.common import GAP, GAP_CHARS, stored

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines"]
#: Transformed statistics: logarithms of word length, of symbols, capitals and
#: lines per word.
VECTOR = ["x_word", "x_symbol", "x_capital", "x_line"]
#: Least standard deviation of each: what is normal variation in any text.
FLOOR = [0.08, 0.3, 0.3, 0.5]
MEDIAN_CHI2 = 3.3567          # median of the chi-square distribution with 4 degrees
BIN = 16                      # bins per unit of a statistic, and per unit of log distance
SALTS = 32                    # shares of a group's rows that meet its parameters separately


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once: a lambda's argument is not
    inlined where it is used many times."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words that lie in a 5-word window which occurs twice or more."""
    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - 4),
                           lambda x, i: F.xxhash64(x, h[i + 1], h[i + 2], h[i + 3], h[i + 4]))

    def repeated(ws: Column) -> Column:
        places = let(F.sort_array(F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i")))), lambda s: F.transform(
            F.filter(s, lambda e, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))].w == e.w)) | ((k < F.size(s) - 1) & (s[F.least(k + 1, F.size(s) - 1)].w == e.w))),
            lambda e: e.i))
        return F.aggregate(F.sort_array(places), F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last")),
                           lambda a, p: F.struct((a.n + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")), lambda a: a.n)

    def counted(h: Column) -> Column:
        return F.when(F.size(h) < 6, F.lit(0)).otherwise(
            let(windows(h), lambda ws: F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(repeated(ws))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), counted)


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus ``COUNTS`` (long) and ``base_failed``.

    Words are runs of anything but ASCII white space.  A null text counts as
    empty: all counts 0, ``base_failed`` true.  Columns of these names are
    replaced.  Whole texts, one row out per row in.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # characters are counted by what is left of the text: regexp_count keeps a
    # string of each match until the last is found
    without = lambda runs: F.length(F.regexp_replace(t, F.lit(runs), F.lit("")))
    trimmed = F.btrim(t, F.lit(GAP_CHARS))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, GAP)).otherwise(F.array().cast("array<string>"))
    by_word = let(words, lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("again")))
    by_line = let(F.filter(F.split(t, "\n"), lambda line: F.length(F.btrim(line, F.lit(GAP_CHARS))) > 0),
                  lambda lines: F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("again")))
    made = df.drop(*COUNTS, "base_failed").withColumn("_w", by_word).withColumn("_l", by_line)
    return (made.withColumns({
        "n_words": F.col("_w.n").cast("long"),
        "word_chars": without(GAP).cast("long"),
        "n_symbols": without(r"[^#*$%&|<>]+").cast("long"),
        "n_dup_lines": F.col("_l.again").cast("long"),
        "n_repeat_words": F.col("_w.again").cast("long"),
        "n_capitals": without(r"[^A-Z]+").cast("long"),
        "n_lines": F.col("_l.n").cast("long"),
    }).drop("_w", "_l").withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")))


def with_vector(df: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Adds ``VECTOR`` and the keys ``_lang`` and ``_source`` (null is a value of
    its own) to rows with ``COUNTS``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    key = lambda c: F.when(F.col(f"`{c}`").isNull(), "-").otherwise(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")))
    return df.withColumns({
        "x_word": F.log1p(F.col("word_chars") / words),
        "x_symbol": F.log1p(20 * F.col("n_symbols") / words),
        "x_capital": F.log1p(10 * F.col("n_capitals") / words),
        "x_line": F.log1p(50 * F.col("n_lines") / words),
        "_lang": key(lang), "_source": key(source),
    })


def grouped(df: DataFrame, sizes: DataFrame, least_rows: int) -> DataFrame:
    """Adds ``_group``: language and source where such a group has ``least_rows``
    rows; the smaller groups of a language together; what is still too small
    together with all such languages."""
    return (df.join(sizes, ["_lang", "_source"], "left")
            .withColumn("_group", F.when(F.col("_n") >= least_rows, F.concat_ws(" ", "_lang", "_source"))
                        .when(F.col("_n_lang") >= least_rows, F.col("_lang")).otherwise(F.lit("")))
            .drop("_n", "_n_lang"))


def group_sizes(df: DataFrame, least_rows: int) -> DataFrame:
    n = df.groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("_n"))
    small = n.where(F.col("_n") < least_rows).groupBy("_lang").agg(F.sum("_n").alias("_n_lang"))
    return n.join(small, "_lang", "left")


def distance(m: list[Column], s: list[list[Column]]) -> Column:
    """Squared Mahalanobis distance of the row's ``VECTOR`` from centre ``m`` for
    the lower Cholesky factor ``s`` of the scatter: forward substitution."""
    y: list[Column] = []
    for i, x in enumerate(VECTOR):
        rest = F.col(x) - m[i]
        for j in range(i):
            rest = rest - s[i][j] * y[j]
        y.append(rest / s[i][i])
    return sum((v * v for v in y[1:]), y[0] * y[0])


P = len(VECTOR)
PARAMETERS = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i in range(P) for j in range(i + 1)]


def own_distance() -> Column:
    return distance([F.col(f"m{i}") for i in range(P)], [[F.col(f"l{i}{j}") for j in range(i + 1)] for i in range(P)])


def from_moments(sums: DataFrame) -> DataFrame:
    """Centre and Cholesky factor per group from ``n``, ``s{i}`` and ``q{i}{j}``."""
    out = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(P)})
    for i in range(P):
        for j in range(i + 1):
            c = F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
            for k in range(j):
                c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # the floor keeps the scatter regular where a statistic hardly varies
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(0.0)) + FLOOR[i] ** 2) if i == j else c / F.col(f"l{j}{j}"))
    return out.select("_group", *PARAMETERS)


def fit(df: DataFrame, steps: int = 4, share: float = 0.75) -> DataFrame:
    """MCD parameters per ``_group``: ``PARAMETERS`` and ``scale``, which sets the
    median squared distance of the group to that of a normal distribution.

    ``df`` is a stored table with ``VECTOR``, ``_group`` and ``_salt``.  Starts from the
    medians and quartile ranges.
    """
    bins = df.select("_group", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(x) * BIN * 4).alias("b")) for i, x in enumerate(VECTOR)])).alias("e"))
    counts = bins.groupBy("_group", "e.i", "e.b").agg(F.count(F.lit(1)).alias("n"))
    axis = Window.partitionBy("_group", "i")
    counts = counts.withColumn("total", F.sum("n").over(axis)).withColumn("upto", F.sum("n").over(axis.orderBy("b")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), (F.col("b") + 0.5) / (BIN * 4)))
    start = counts.groupBy("_group", "i").agg(at(0.25).alias("low"), at(0.5).alias("mid"), at(0.75).alias("high"))
    own = lambda c, i: F.max(F.when(F.col("i") == i, c))
    start = start.groupBy("_group").agg(
        *[own(F.col("mid"), i).alias(f"m{i}") for i in range(P)],
        *[(own(F.sqrt(((F.col("high") - F.col("low")) / 1.349) ** 2 + F.lit(FLOOR[i]) ** 2), i) if i == j else F.lit(0.0)).alias(f"l{i}{j}")
          for i in range(P) for j in range(i + 1)])
    params = stored(start.select("_group", *PARAMETERS), "mcd-start")
    for step in range(steps):
        params = stored(from_moments(nearest(df, params, share)), f"mcd-{step}")
    own_bins = binned(df, params).groupBy("_group", "_bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("_group")
    middle = (own_bins.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("_bin")))
              .where(F.col("upto") * 2 >= F.col("total")).groupBy("_group").agg(F.min("_bin").alias("b")))
    scale = middle.select("_group", F.greatest(F.exp((F.col("b") + 0.5) / BIN) / MEDIAN_CHI2, F.lit(1.0)).alias("scale"))
    return stored(params.join(scale, "_group"), "mcd-fit")


def share() -> Column:
    return F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")


def in_shares(params: DataFrame) -> DataFrame:
    """Parameters repeated per share: a group holding a third of all rows joins
    in many tasks, and is aggregated there before its rows come together."""
    return params.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def binned(df: DataFrame, params: DataFrame) -> DataFrame:
    return (df.join(in_shares(params), ["_group", "_salt"]).drop("_salt")
            .withColumn("_bin", F.floor(F.log(own_distance() + 1e-6) * BIN)))


def nearest(df: DataFrame, params: DataFrame, share: float) -> DataFrame:
    """Moments of each group's nearest rows: whole distance bins until ``share``
    of the rows is reached."""
    x = [F.col(c) for c in VECTOR]
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(P)],
            *[F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i in range(P) for j in range(i + 1)]]
    per_bin = binned(df, params).groupBy("_group", "_bin").agg(*sums)
    w = Window.partitionBy("_group")
    per_bin = per_bin.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("_bin")))
    inside = per_bin.where(F.col("upto") - F.col("n") < share * F.col("total"))
    return inside.groupBy("_group").agg(*[F.sum(c).alias(c) for c in per_bin.columns if c not in ("_group", "_bin", "total", "upto")])


class RobustQuality:
    """The operator: fit on a corpus, then judge rows.

    ``cutoff`` bounds the squared distance, in units where a normal group's
    median is that of a chi-square with four degrees (its 0.999999 quantile is
    33).  Groups of fewer than ``least_rows`` rows are fitted together with the
    others of their language; if even all such leftovers are too few, they are
    not judged.  Rows that fail the base rules are kept out of the fit.
    """

    def __init__(self, cutoff: float = 40.0, least_rows: int = 100, lang: str = "lang", source: str = "source"):
        self.cutoff, self.least_rows, self.lang, self.source = cutoff, least_rows, lang, source
        self.sizes: DataFrame | None = None
        self.params: DataFrame | None = None

    def fit(self, rows: DataFrame) -> RobustQuality:
        """``rows``: a stored table with ``COUNTS``, ``base_failed`` and the key
        columns."""
        good = with_vector(rows, self.lang, self.source).where("NOT base_failed")
        self.sizes = stored(group_sizes(good, self.least_rows), "mcd-sizes")
        good = stored(grouped(good, self.sizes, self.least_rows).select("_group", *VECTOR, share().alias("_salt")), "mcd-rows")
        enough = good.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= self.least_rows).select("_group")
        self.params = fit(good).join(enough, "_group", "left_semi")
        return self

    def judge(self, rows: DataFrame) -> DataFrame:
        """``rows`` plus ``distance`` (null where not judged) and ``kept``."""
        names = [c for c in rows.columns if c not in ("distance", "kept")]
        judged = grouped(with_vector(rows.select(*[F.col(f"`{c}`") for c in names]), self.lang, self.source), self.sizes, self.least_rows)
        judged = judged.withColumn("_salt", share()).join(in_shares(self.params), ["_group", "_salt"], "left").withColumn("distance", own_distance() / F.col("scale"))
        return (judged.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= self.cutoff))
                .select(*[F.col(f"`{c}`") for c in names], "distance", "kept"))


def judge_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", **rules) -> DataFrame:
    """Every row's columns but ``text``, with ``COUNTS``, ``base_failed``,
    ``distance`` and ``kept``.

    Null texts fail the base rules.  A null language or source is a group of
    its own.  Repeated rows each get their own row and count in the fit; an
    empty table gives an empty table; columns of the result's names are
    replaced.
    """
    rows = stored(with_counts(docs, text).drop(text), "quality-counts")
    return RobustQuality(lang=lang, source=source, **rules).fit(rows).judge(rows)
