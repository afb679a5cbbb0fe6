"""Line dedup and quality rules against brute force."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoframe.llm import linededup, outliers
from meteoframe.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_boilerplate_against_brute_force(spark):
    rows = [(i, f"h{i % 2}", "\n".join([" menu " if i % 4 < 3 else "own menu", f"text {i}", "", f"text {i}", "foot" if i % 8 == 0 else "-"])) for i in range(80)]
    rows += [(100, None, "menu\nx"), (101, "h0", None), (102, "h0", ""), (103, "h0", "menu"), (3, "h1", rows[3][2])]
    out = linededup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, source string, text string"), ratio=0.3).collect()
    total, seen = collections.Counter(r[1] for r in rows), collections.Counter()
    for _, host, text in rows:
        seen.update({(host, line.strip()) for line in (text or "").split("\n") if line.strip()})
    bad = {k for k, n in seen.items() if n >= 5 and n > 0.3 * total[k[0]]}
    want = []
    for key, host, text in rows:
        lines = (text or "").split("\n")
        rest = [x for x in lines if (host, x.strip()) not in bad]
        worded = sum(bool(x.strip()) for x in lines)
        left = sum(bool(x.strip()) for x in rest)
        gone = worded - left if left else 0
        want.append((key, host or "", "\n".join(rest) if gone else text or "", worded, gone))
    assert sorted((r.doc_id, r.source or "", r.text or "", r.n_lines, r.n_dropped) for r in out) == sorted(want)
    assert any(w[4] for w in want) and ("h0", "menu") in bad


def test_planted_passages_go_from_a_large_and_a_small_host_and_copies_stay(spark):
    passage = " ".join(f"word{k}" for k in range(60))                     # over 50 words, on 2 % of each host's pages
    own = lambda i: "\n".join(f"line {j} of page {i} with words of its own" for j in range(14))
    rows = [(i, "large" if i < 3000 else "small", own(i) + ("\n" + passage if i % 50 == 0 else "") + ("\nrare line on a few pages" if i in (1, 2, 3, 4, 5) else "")
             + ("\nyes" if i % 20 == 0 else "")) for i in range(3400)]
    rows += [(5000 + i, "large", own(-1) + f"\nchanged in copy {i}") for i in range(300)]       # near copies
    out = {r.doc_id: r for r in linededup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    given = {i: text for i, _, text in rows}
    caught = [i for i in given if passage in given[i] and passage not in out[i].text]
    assert len(caught) == 68 and all(out[i].n_dropped == 1 for i in caught)                     # all 60 + 8
    assert all(out[i].text == given[i] for i in given if i not in caught)                       # rare and short lines, copies


def test_lines_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string, n_lines string")
    out = linededup.drop_boilerplate(df)
    assert out.columns == ["doc_id", "source", "text", "n_lines", "n_dropped"] and out.count() == 0


def counts(text):
    text = text or ""
    words, places = WORD.findall(text), collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i:i + 5])].append(i)
    again = {k for v in places.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


TEXTS = [None, "", " \n\t ", "a", "a a a a a a", "a b c d e a b c d e f", "a b c d e f a b c d e", "x\ny\nx\n x\n\nx", "é|ß <b> 🙂 # $%& a b c d",
         "a b c d e\x0bq\x1cr s " * 3, "one two three four five six seven eight nine ten eleven", "w " * 30000 + "end", " a b c"]


def test_counts_against_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in outliers.with_counts(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_characters_are_counted_without_a_list_of_matches(spark):
    texts = [None, "", " \t\n\x0b\f\r", "#*$%&|<>", "ABC", "Aé\U0001F600 b|C\u00a0d\n\n$$ Z", "x" * 20000, "A b " * 5000]
    df = outliers.with_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()
    found = {r.doc_id: (r.word_chars, r.n_symbols, r.n_capitals) for r in df.collect()}
    for i, t in enumerate(texts):
        t = t or ""
        assert found[i] == (len(re.sub(r"[\x20\x09-\x0d]", "", t)), sum(c in "#*$%&|<>" for c in t), len(re.findall("[A-Z]", t)))


def brute_mcd(x: np.ndarray, steps: int = 4, share: float = 0.75) -> np.ndarray:
    """The estimate, row by row in numpy."""
    floor = np.diag(np.array(outliers.FLOOR) ** 2)
    grid = np.floor(x * outliers.BIN * 4)

    def at(column, q):
        values = np.sort(column)
        return (values[int(np.ceil(q * len(values))) - 1] + 0.5) / (outliers.BIN * 4)

    m = np.array([at(c, 0.5) for c in grid.T])
    s = np.diag([((at(c, 0.75) - at(c, 0.25)) / 1.349) ** 2 for c in grid.T]) + floor

    def bins(m, s):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
        return d, np.floor(np.log(d + 1e-6) * outliers.BIN)

    for _ in range(steps):
        d, b = bins(m, s)
        inside = np.array([(b < v).sum() < share * len(x) for v in b])
        m, s = x[inside].mean(0), np.cov(x[inside].T, bias=True) + floor
    d, b = bins(m, s)
    middle = np.sort(b)[int(np.ceil(len(b) / 2)) - 1]
    return d / max(np.exp((middle + 0.5) / outliers.BIN) / outliers.MEDIAN_CHI2, 1.0)


def test_distances_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        n = int(rng.integers(20, 300))
        odd = i % 20 == 0
        rows.append((i, "en", "s" if i % 3 else "t", n, int(n * (9 if odd else rng.normal(5, 0.4))), int(n * odd), 0, 0, int(n * 0.1), max(1, n // 15), False))
    names = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_capitals long, n_lines long, base_failed boolean"
    df = stored(spark.createDataFrame(rows, names), "test-counts")
    got = outliers.RobustQuality().fit(df).judge(df).collect()
    vectors = {r.doc_id: [r[x] for x in outliers.VECTOR] for r in outliers.with_vector(df).collect()}
    for source in "st":
        own = sorted(r.doc_id for r in got if r.source == source)
        want = dict(zip(own, brute_mcd(np.array([vectors[i] for i in own]))))
        for r in got:
            if r.source == source:
                assert r.distance == pytest.approx(want[r.doc_id], rel=1e-6)
                assert r.kept == (r.doc_id % 20 != 0)


def test_verdicts_on_edges(spark):
    rows = [(i, "plain words here and there are many of them today my friend " + str(i), "en" if i % 2 else None, None) for i in range(250)]
    rows += [(1000, None, None, "s"), (1001, "", "en", "s"), (3, rows[3][1], "en", None), (None, rows[5][1], "en", None)]
    rows += [(2000, "### $$$ %%% &&& ||| ### $$$$ %%%% &&&& |||| <<<< >>>>", "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit("clash"))
    out = {}
    for r in outliers.judge_documents(df, least_rows=100).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert len(out[3]) == 2 and all(r.kept for r in out[3] + out[None])
    assert not out[1000][0].kept and out[1000][0].base_failed and not out[2000][0].kept and not out[2000][0].base_failed
    assert sum(r.kept for v in out.values() for r in v) == 252
    assert outliers.judge_documents(df.limit(0)).count() == 0


def test_small_groups_are_not_judged(spark):
    rows = [(i, "w " * 5 + " ".join(f"q{i}{k}" for k in range(20)), "en", f"s{i}") for i in range(20)]
    out = outliers.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(r.kept and r.distance is None for r in out)
