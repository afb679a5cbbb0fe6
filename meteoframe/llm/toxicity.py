"""Toxicity by weak supervision.

Many weak voters look at a text: hand-written lexicons, lexicons mined from
the labelled rows, and patterns (shouting, exclamations, masked words, nothing
suspicious).  A generative label model - expectation maximisation over the
hidden class - estimates how accurate each voter is and which voters are
correlated; correlated ones vote as one, by their joint outcome.  Its posterior
labels train a linear classifier over votes and words, which scores every
document.

The models are fitted on at most ``sample_rows`` labelled rows (chosen by a
hash of the id) and passed to the tasks; scoring is one pass without shuffle.
Language, source and id are never inputs of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import lean, remainder, slices, word_runs

#: General insults and abuse, by kind.
LEXICONS = {
    "wits": "idiot idiots moron morons stupid dumb dumbass imbecile fool retard retarded brainless",
    "contempt": "pathetic loser losers worthless useless hopeless coward",
    "filth": "trash garbage scum filth filthy vermin rat pig pigs",
    "disgust": "disgusting gross vile repulsive revolting nasty",
    "ridicule": "clown clowns freak freaks creep weirdo joke",
    "profanity": "fuck fucking shit bitch bastard asshole damn crap whore slut",
    "threat": "kill die hurt destroy hate hang shoot",
    "other": "arschloch idiota imbécil mierda puta connard salope merde crétin dummkopf schwein abschaum",
}
MINED = 4                       # mined lexicons
PATTERNS = ["shouting", "exclaiming", "masked", "calm"]
VOTERS = [*LEXICONS, *(f"mined{i}" for i in range(MINED)), *PATTERNS]
EDGES = ".,;:!?\"'()[]{}«»“”‘’*#$%&-_|<>/\\"
MASKED = re.compile(rb"[A-Za-z][*#@$%]{2,}[A-Za-z]")


def features_of(word: str) -> list[str]:
    """A word and its stems: prefixes of 4, 6 and 8 letters, marked by a dash."""
    return [word, *(word[:n] + "-" for n in (4, 6, 8) if len(word) > n)]


class Texts:
    """A slice of texts as distinct lower-case words per text, with counts of
    characters."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        self.n = len(texts)
        found, index, places = word_runs(texts)
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + self.n + 1].astype(np.int64)
        data = texts.buffers()[2]
        self.raw = memoryview(data)[ends[0]:ends[-1]] if data is not None else b""
        b, self.ends = np.frombuffer(self.raw, np.uint8), ends - ends[0]
        plain = [x.decode().lower().strip(EDGES) for x in found]
        names = {w: i for i, w in enumerate(dict.fromkeys(plain))}
        self.words = list(names)
        own = np.array([names[w] for w in plain], np.int64)[index] if found else np.zeros(0, np.int64)
        pairs = np.unique(np.repeat(np.arange(self.n), np.diff(places)) * max(len(names), 1) + own)
        self.doc, self.word = pairs // max(len(names), 1), pairs % max(len(names), 1)
        upper = (b >= 0x41) & (b <= 0x5A)
        lower = (b >= 0x61) & (b <= 0x7A)
        self.upper, self.lower = self._count(upper), self._count(lower)
        self.marks = self._count(b == 0x21)
        masked = np.zeros(len(b), bool)
        masked[[m.start() for m in MASKED.finditer(self.raw)]] = True
        self.masked = self._count(masked)

    def _count(self, flags: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flags)])
        return upto[self.ends[1:]] - upto[self.ends[:-1]]


@dataclass
class Model:
    """Everything a task needs: lexicon of each word or stem (bit mask), weights
    of votes, words and stems."""

    masks: dict[str, int] = field(default_factory=dict)
    vote_weights: np.ndarray | None = None
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    accuracy: dict[str, float] = field(default_factory=dict)
    correlated: list[list[str]] = field(default_factory=list)

    def votes(self, t: Texts) -> np.ndarray:
        """Texts x voters: 1 toxic, -1 not toxic, 0 no opinion."""
        masks = np.array([self.of(w)[0] for w in t.words], np.int64)
        hit = masks[t.word] if len(t.words) else np.zeros(0, np.int64)
        some = np.flatnonzero(hit)
        own = np.zeros(t.n, np.int64)
        np.bitwise_or.at(own, t.doc[some], hit[some])
        v = np.zeros((t.n, len(VOTERS)), np.int8)
        lexicons = len(LEXICONS) + MINED
        for i in range(lexicons):
            v[:, i] = own >> i & 1
        v[:, lexicons] = (t.upper > 20) & (t.upper > t.lower)
        v[:, lexicons + 1] = t.marks >= 3
        v[:, lexicons + 2] = t.masked > 0
        v[:, lexicons + 3] = -(~v.any(1)).astype(np.int8)
        return v

    def __post_init__(self):
        self._known: dict[str, tuple[int, float]] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def of(self, word: str) -> tuple[int, float]:
        """Lexicons and weight of a word, from a bounded table of words met."""
        found = self._known.get(word)
        if found is None:
            if len(self._known) > 200_000:
                self._known.clear()
            own = features_of(word)
            found = self._known[word] = self._mask(own), sum(self.weights.get(f, 0.0) for f in own)
        return found

    def _mask(self, own: list[str]) -> int:
        m = 0
        for f in own:
            m |= self.masks.get(f, 0)
        return m

    def score(self, t: Texts) -> np.ndarray:
        value = np.array([self.of(w)[1] for w in t.words] or [0.0])
        total = self.bias + self.votes(t) @ self.vote_weights
        if len(t.words):
            total = total + np.bincount(t.doc, value[t.word], t.n)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def seeds() -> dict[str, int]:
    return {w: 1 << i for i, words in enumerate(LEXICONS.values()) for w in words.split()}


# ------------------------------------------------------------ label model

def label_model(votes: np.ndarray, prior: float, rounds: int = 40, link: float = 0.3) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Posterior of the toxic class, accuracy per voter, and groups of correlated
    voters.

    First every voter stands alone; voters whose votes correlate beyond ``link``
    within the classes then form groups of up to three, whose joint outcome is
    one categorical vote of the model.
    """
    n, m = votes.shape
    post = np.clip(prior + 0.35 * np.tanh(votes.sum(1)), 0.02, 0.98)
    groups = [[i] for i in range(m)]
    for stage in range(2):
        codes = [np.ravel_multi_index([votes[:, i] + 1 for i in g], [3] * len(g)) for g in groups]
        for _ in range(rounds):
            p1 = np.clip(post.mean(), 1e-3, 1 - 1e-3)
            odds = np.full(n, np.log(p1 / (1 - p1)))
            for g, code in zip(groups, codes):
                k = 3 ** len(g)
                one = np.bincount(code, post, k) + 0.5
                none = np.bincount(code, 1 - post, k) + 0.5
                odds += (np.log(one / one.sum()) - np.log(none / none.sum()))[code]
            post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if stage:
            break
        within = np.zeros((m, m))
        for w in (post, 1 - post):
            mean = w @ votes / max(w.sum(), 1e-9)
            c = (votes - mean).T @ ((votes - mean) * w[:, None])
            sd = np.sqrt(np.maximum(np.diag(c), 1e-9))
            within += c / np.outer(sd, sd) * w.sum() / n
        for i, j in sorted(((i, j) for i in range(m) for j in range(i) if within[i, j] > link), key=lambda p: -within[p]):
            a, b = next(g for g in groups if i in g), next(g for g in groups if j in g)
            if a is not b and len(a) + len(b) <= 3:
                groups.remove(b)
                a += b
    voted = votes != 0
    right = np.where(votes > 0, post[:, None], 1 - post[:, None])
    accuracy = (right * voted).sum(0) / np.maximum(voted.sum(0), 1)
    return post, accuracy, [g for g in groups if len(g) > 1]


def linear_fit(x: np.ndarray, y: np.ndarray, ridge: float = 2.0, rounds: int = 15) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps, in blocks of
    rows; the last column of ``x`` is all ones and its coefficient the bias."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        curve, slope = np.diag(penalty), penalty * w
        for i in range(0, len(x), 2048):
            b = x[i:i + 2048].astype(float)
            p = 1 / (1 + np.exp(-np.clip(b @ w, -30, 30)))
            curve = curve + (b * (p * (1 - p))[:, None]).T @ b
            slope = slope + b.T @ (p - y[i:i + 2048])
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = 20_000, words: int = 600) -> Model:
    """Model from the labelled rows whose id's crc32 is not divisible by 5, of
    which at most ``sample_rows`` are used.

    Rows of one id count once, with the text of the smallest hash.  Ids with
    several labels count as toxic if one says so; null labels and ids
    do not count.  Without any labelled row the model is the plain lexicons.
    """
    key, y = F.col(f"`{doc_id}`"), F.col(f"`{label}`")
    chosen = (labels.where(key.isNotNull() & y.isNotNull() & (remainder(key) != 0)).groupBy(key.alias("id")).agg(F.max(y.cast("int")).alias("y"))
              .sort(F.xxhash64("id"), "id").limit(sample_rows))
    sample = lean(docs).select(key.alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "id")
    # an id's rows are one, by the text's hash, so that at most sample_rows rows are used however often an id repeats
    sample = sample.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("_own"), F.max("y").alias("y")).select("_own.text", "y")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            t, label_ = Texts(b.column(0)), b.column(1).to_numpy()
            index: dict[str, int] = {}
            own = [[index.setdefault(f, len(index)) for f in features_of(w)] for w in t.words]
            sizes = np.array([len(o) for o in own] or [0])
            flat = np.array([i for o in own for i in o], np.int64)
            first = np.cumsum(sizes) - sizes
            times = sizes[t.word]
            doc = np.repeat(t.doc, times)
            which = flat[np.repeat(first[t.word] - (np.cumsum(times) - times), times) + np.arange(times.sum())] if len(doc) else flat
            pairs = np.unique(doc * max(len(index), 1) + which)
            doc, which = pairs // max(len(index), 1), pairs % max(len(index), 1)
            toxic = np.bincount(which, label_[doc], len(index)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(index), pa.string()), pa.array(toxic), pa.array(np.bincount(which, minlength=len(index)).astype(np.int64) - toxic)],
                names=["feature", "toxic", "clean"])

    balance = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = balance.get(1, 0), sum(v for k, v in balance.items() if k != 1)
    model = Model(masks=seeds())
    if not n1 + n0:
        model.vote_weights = np.array([2.0] * (len(LEXICONS) + MINED) + [0.5, 0.5, 1.0, 2.0])
        model.bias = -1.0
        return model
    counts = sample.mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    rate1, rate0 = F.col("t") / max(n1, 1), F.col("c") / max(n0, 1)
    both = (F.col("t") + F.col("c")) / (n1 + n0)
    z = (rate1 - rate0) / F.sqrt(both * (1 - both) * (1 / max(n1, 1) + 1 / max(n0, 1)) + 1e-12)
    counts = counts.where("t + c >= 5").withColumn("z", z).where("abs(z) >= 5")
    top = counts.sort(F.abs("z").desc(), "feature").limit(words).collect()
    mined = [r.feature for r in top if r.z > 0 and r.t >= 4 * (r.c + 1)]      # right four times out of five
    for i, f in enumerate(mined):
        model.masks[f] = model.masks.get(f, 0) | 1 << (len(LEXICONS) + i % MINED)

    names = {r.feature: i for i, r in enumerate(top)}

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            t = Texts(b.column(0))
            found: list[dict] = [{} for _ in range(t.n)]
            own = [[names[f] for f in features_of(w) if f in names] for w in t.words]
            useful = np.array([bool(o) for o in own] or [False])
            for d, w in zip(t.doc.tolist(), t.word.tolist()):
                if useful[w]:
                    for i in own[w]:
                        found[d][i] = found[d].get(i, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.votes(t).tolist(), pa.list_(pa.int32())), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int32())), b.column(1)], names=["votes", "at", "times", "y"])

    rows = sample.mapInArrow(observe, "votes array<int>, at array<int>, times array<int>, y int").collect()
    rows.sort(key=lambda r: (r.votes, r.at, r.times, r.y))        # the same sums whatever order rows come in
    votes = np.array([r.votes for r in rows], np.int64)
    y = np.array([r.y for r in rows])
    x = np.zeros((len(rows), len(VOTERS) + len(names) + 1), np.float32)
    x[:, :len(VOTERS)] = votes
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, [len(VOTERS) + j for j in r.at]] = r.times
    del rows
    # the given labels are one more, very good but not perfect voter
    post, accuracy, groups = label_model(np.hstack([votes, (2 * y - 1)[:, None]]), prior=n1 / (n1 + n0))
    w = linear_fit(x, post)
    known = [*VOTERS, "given label"]
    model.accuracy = dict(zip(known, accuracy.round(4).tolist()))
    model.correlated = [[known[i] for i in g] for g in groups]
    model.vote_weights = w[:len(VOTERS)]
    model.weights = {f: float(w[len(VOTERS) + i]) for f, i in names.items()}
    model.bias = float(w[-1])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1), without ``text`` unless ``keep_text``.

    One row out per row in; null texts count as empty and get the score of a
    text without words; columns named ``score`` are replaced.
    """
    keep = [c for c in docs.columns if c != "score" and (keep_text or c != text)]
    source = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"keep{i}") for i, c in enumerate(keep)])
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[1:]), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(model.score(Texts(b.column(0))), pa.float64())],
                                             names=[*b.schema.names[1:], "score"])

    out = lean(source).mapInArrow(run, schema)
    return out.select(*[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)], "score")
