"""Joins, neighbours, scores and extraction against brute force."""

import collections
import functools
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoframe.llm import components, htmlcut, katz, ngramjoin, nndescent, toxicity
from meteoframe.llm.common import remainder


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ------------------------------------------------------------- components

@pytest.mark.parametrize("edges", [[(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)], [(9, 3), (3, 9), (7, 7), (5, 2), (2, 9)], []])
def test_components(spark, edges):
    out = dict(tuple(r) for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect())
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert out == roots(nodes, [e for e in edges if e[0] != e[1]])


# ------------------------------------------------------------ n-gram join

def gram_set(text, n=5):
    words = (text or "").split()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    rows = []
    for group in range(12):
        base = [word() for _ in range(rng.choice([6, 60, 400]))]
        for copy in range(rng.choice([1, 2, 5, 40])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, len(base) // 30])):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "a  b"), (905, "a b c"), (906, rows[0])]


@pytest.mark.parametrize("tile_rows", [512, 7])
def test_join_against_brute_force(spark, tile_rows):
    rows = corpus()
    out = ngramjoin.jaccard_join(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int"), tile_rows=tile_rows).collect()
    sets = {i: gram_set(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    count = collections.Counter(itertools.chain(*links))
    assert {r.doc_id: (r.n_links, r.class_id) for r in out} == {i: (count[i], c) for i, c in roots(sets, links).items()}
    assert {r.doc_id: r.copy_id for r in out}[904] == 903 and len(out) == len(rows)


def test_join_repeated_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None)]
    out = sorted(((r.doc_id or 0), r.n_links, r.class_id) for r in ngramjoin.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(0, 0, None), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert ngramjoin.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands_reach_the_target():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = ngramjoin.choose_bands(threshold, 0.999)
        assert 1 - (1 - threshold ** rows) ** bands >= 0.999 and bands * rows <= 128


# ---------------------------------------------------------------- vectors

def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    x = [base[rng.integers(40)] * rng.uniform(0.5, 2) + rng.normal(size=16) * 0.12 for _ in range(300)] + [base[0] + rng.normal(size=16) * 0.05 for _ in range(60)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (600, None), (601, [0.0] * 16), (602, []), (603, [float("nan")] * 16), (604, [None] + [1.0] * 15),
             (605, [float("inf")] * 16), (606, [1.0, 2.0]), (607, [2.0, 4.0]), (None, rows[3][1])]
    found = nndescent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    cos = lambda a, b: a @ b / math.sqrt((a @ a) * (b @ b)) if len(a) == len(b) else 0.0
    links = [(a, b) for a, b in itertools.combinations(sorted(good), 2) if cos(good[a], good[b]) >= 0.9]
    count, root = collections.Counter(itertools.chain(*links)), roots([i for i, _ in rows if i is not None], links)
    out = found.rows.collect()
    assert found.recall >= 0.99 and len(out) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out if r.vec_id is not None} == {i: (count[i], c, i == c) for i, c in root.items()}
    assert max(count.values()) > 40          # fuller than any neighbour list


def two_groups(m: int, cosine: float, spread: float) -> np.ndarray:
    rng = np.random.default_rng(8)
    a, b = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
    centres = np.stack([a, cosine * a + math.sqrt(1 - cosine ** 2) * b])
    return np.repeat(centres, m, 0) + rng.normal(size=(2 * m, 64)) * spread / 8


def test_links_between_dense_groups(spark):
    x = two_groups(300, 0.92, 0.2)
    x /= np.sqrt((x * x).sum(1))[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    assert near[:300, 300:].any() and near[:300, :300].sum(1).min() > 16      # every list is full of its own group
    out = nndescent.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).rows.collect()
    assert {r.vec_id: r.n_links for r in out} == dict(enumerate(near.sum(1).tolist())) and {r.component_id for r in out} == {0}


def test_hash_tables_reach_the_recall():
    for count in (500, 2000, 36000, 10 ** 5, 10 ** 6, 10 ** 7):
        bits, tables = nndescent.choose_tables(count, 0.9, 0.999)
        assert count / 2 ** bits <= nndescent.BLOCK / 2 and 1 - (1 - (1 - math.acos(0.9) / math.pi) ** bits) ** tables >= 0.999


def test_far_neighbours_stay_in_the_lists(spark):
    x = np.random.default_rng(3).normal(size=(400, 64))
    vectors = spark.createDataFrame([(i, v.astype("<f8").tobytes()) for i, v in enumerate(x)], "node long, payload binary")
    lists = nndescent.top_lists(nndescent.seed_pairs(vectors, *nndescent.choose_tables(400, 0.9, 0.999), 11, 0.9, 0.6, 16), 16)
    sizes = [r["count"] for r in lists.groupBy("a").count().collect()]
    assert len(sizes) == 400 and min(sizes) >= 2


def test_audit_weighs_nodes_alike(spark):
    rng = np.random.default_rng(2)
    lone = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    x = np.concatenate([lone[0] + rng.normal(size=(300, 64)) * 0.01, np.repeat(lone[1:41], 2, 0) + rng.normal(size=(80, 64)) * 0.01])
    vectors = spark.createDataFrame([(i, v.astype("<f8").tobytes()) for i, v in enumerate(x)], "node long, payload binary")
    pools = spark.createDataFrame([(i, 0) for i in range(300)], "node long, component long")
    assert nndescent.audit(vectors, pools, 0.9) == pytest.approx(300 / 380)    # 40 lost pairs beside 44,850 met


def test_what_attempts_miss_is_compared(spark):
    x = two_groups(80, 0.5, 0.3)
    x /= np.sqrt((x * x).sum(1))[:, None]
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for tries, target in ((0, 0.99), (1, 1.01)):
        found = nndescent.near_duplicates(df, tables=1, rounds=0, target=target, most_tries=tries)
        assert found.recall == 1 and {r.vec_id: r.n_links for r in found.rows.collect()} == dict(enumerate(near.sum(1).tolist()))


def test_no_vectors(spark):
    assert nndescent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).rows.count() == 0


# ------------------------------------------------------------------- Katz

@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_against_brute_force(spark, order):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "unheard of words W1"), (None, "w1 w2"), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string").repartition(3)
    train = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 != 1
    model = katz.score_corpus(df, remainder(F.col("doc_id")) != 1, order=order)
    tokens = [(i, [*(t or "").lower().split(), "</s>"]) for i, t in rows]

    def ends(t, n):                          # n-grams by the token they end at; the start stands in front once
        full = ["<s>", *t]
        return [tuple(full[j - n + 1:j + 1]) for j in range(1, len(full)) if j - n + 1 >= 0]

    counts = {n: collections.Counter(g for i, t in tokens if train(i) for g in ends(t, n)) for n in range(1, order + 1)}
    words = {g[0]: c for g, c in counts[1].items()}
    factors = {n: katz.discounts(np.array([sum(v == r for v in c.values()) for r in range(1, katz.TOP + 2)])) for n, c in counts.items()}

    def cut(n, c):
        f, flat = factors[n]
        return c - flat if c > katz.TOP else f[c] * c

    total = sum(words.values())
    unknown = 1 - sum(cut(1, c) for c in words.values()) / total
    after = collections.defaultdict(list)
    for n in range(2, order + 1):
        for g in counts[n]:
            after[g[:-1]].append(g[-1])
    times = {h: sum(counts[len(h) + 1][(*h, w)] for w in seen) for h, seen in after.items()}

    @functools.cache
    def alpha(h):
        return (1 - sum(cut(len(h) + 1, counts[len(h) + 1][(*h, w)]) for w in after[h]) / times[h]) / (1 - sum(p(w, h[1:]) for w in after[h]))

    @functools.cache
    def p(w, h):
        if not h:
            return cut(1, words[w]) / total if w in words else unknown
        c = counts[len(h) + 1][(*h, w)]
        return cut(len(h) + 1, c) / times[h] if c else (alpha(h) if h in times else 1) * p(w, h[1:])

    for h in list(times)[::7]:               # a history's probabilities add up to one
        assert sum(p(w, h) for w in [*words, "never seen"]) == pytest.approx(1)
    want = []
    for i, t in tokens:
        full = ["<s>", *t]
        value = sum(math.log10(p(full[j], tuple(full[max(0, j - order + 1):j]))) for j in range(1, len(full)))
        base = sum(math.log10((words.get(w, 0) + 0.5) / (total + 0.5 * (len(words) + 1))) for w in t)
        want.append((i if i is not None else -1, not train(i), len(t), sum(w in words for w in t), total, round(base, 8), round(value, 8)))
    got = [(r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8), round(r.score, 8)) for r in model.rows.collect()]
    assert sorted(got) == sorted(want)
    for n in range(1, order + 1):
        assert sum(len(katz.spread(r.counts, np.int64)) for r in model.of(n).collect()) == len(counts[n])


def test_what_only_a_later_step_reads_does_not_stay(spark, monkeypatch, tmp_path):
    """Answers and reports, most of the bytes, are gone once they have been read; the
    texts meet the answers in shares; the highest order's n-grams have no places."""
    monkeypatch.setattr(katz, "scratch_path", lambda _, name: str(tmp_path / name))
    seen = []
    removed = katz.removed
    monkeypatch.setattr(katz, "removed", lambda s, path: (seen.append((path, spark.read.parquet(path).collect())), removed(s, path)))
    rows = [(i, f"a b{i % 5} c{i % 3} d") for i in range(40)]
    source = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    model = katz.score_corpus(source, F.col("doc_id") % 5 != 1, order=3)
    assert model.rows.count() == 40 and [model.of(n).count() > 0 for n in (1, 2, 3)] == [True] * 3
    left = {str(p.relative_to(tmp_path)) for p in tmp_path.glob("*/*=*")}
    assert left == {"katz-counts/what=table", f"katz-judged/bucket={katz.DOCS}"}
    (answers,) = [r for path, r in seen if path.endswith("what=answer")]
    assert {r.kind for r in answers} == {0, 1, 2} and all((r["keys"] is None) == (r.kind == 2) for r in answers)
    reports = [r for path, got in seen if "bucket=" in path for r in got]
    assert {r.what for r in reports} == {"report", "unseen"} and len({r.slice >> 24 for r in answers}) == 6


def test_scores_without_training_or_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = katz.score_corpus(df, F.lit(False)).rows.first()
    assert (r.score, r.base_score, r.n_known, r.train_tokens) == (0, 0, 0, 0)
    assert katz.score_corpus(df.limit(0), F.lit(True)).rows.count() == 0


# --------------------------------------------------------------- toxicity

def toxic_corpus(n=600, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"v{rng.randrange(300)}" for _ in range(rng.randint(5, 80))]
        bad = i % 6 == 0
        if bad:
            kinds = ["idiot", "scum,"] if i % 12 else ["zorgan", "zorgut.", "zorgel"]
            for k in kinds:
                words.insert(rng.randrange(len(words)), k)
        docs.append((i, " ".join(words), "en"))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxic_documents_are_found_and_others_left(spark):
    docs, labels = toxic_corpus()
    d = spark.createDataFrame([*docs, (9000, None, "en"), (9001, "", "en"), (5, docs[5][1], "en")], "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (0, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, lab)
    out = toxicity.score(d, model).collect()
    assert len(out) == len(docs) + 3 and all(0 <= r.score <= 1 for r in out)
    wrong = [r for r in out if r.doc_id < 9000 and (r.score >= 0.5) != (r.doc_id % 6 == 0)]
    assert len(wrong) <= 3 and not any(r.score >= 0.5 for r in out if r.doc_id >= 9000)
    assert model.accuracy["wits"] > 0.9


def test_a_repeated_id_counts_once(spark):
    docs, labels = toxic_corpus(200)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    hot = next(i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5)
    again = d.unionByName(d.where(F.col("doc_id") == hot).crossJoin(spark.range(300)).drop("id"))
    one, other = toxicity.fit(d, lab), toxicity.fit(again, lab)
    assert np.allclose(one.vote_weights, other.vote_weights) and one.accuracy == other.accuracy and one.bias == pytest.approx(other.bias)


def test_held_out_labels_change_nothing(spark):
    docs, labels = toxic_corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (toxicity.fit(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert a.weights == b.weights and a.bias == b.bias


def test_no_labels_falls_back_to_lexicons(spark):
    d = spark.createDataFrame([(1, "you idiot scum"), (2, "a fine day"), (3, None)], "doc_id long, text string")
    out = {r.doc_id: r.score for r in toxicity.score(d, toxicity.fit(d, spark.createDataFrame([], "doc_id long, toxic int"))).collect()}
    assert out[1] > 0.5 > out[2] and out[3] < 0.5
    assert toxicity.score(d.limit(0), toxicity.Model(vote_weights=np.zeros(len(toxicity.VOTERS)))).count() == 0


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(6)
    y = rng.random(4000) < 0.3
    accuracy = [0.9, 0.8, 0.75, 0.85, 0.7]
    votes = np.array([np.where(rng.random(4000) < a, y, ~y) * 2 - 1 for a in accuracy]).T
    votes = np.hstack([votes, votes[:, :1]])          # a copy of the first voter
    post, found, groups = toxicity.label_model(votes, 0.3)
    assert [0, 5] in [sorted(g) for g in groups]
    assert np.abs(found[:5] - accuracy).max() < 0.06 and ((post > 0.5) == y).mean() > 0.9


# ------------------------------------------------------------- extraction

PAGE = """<html><head><title>T</title><script>if(a<b){"</p>"}</script></head><body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies.</div><div id=main><main><article class="post"><header><h1>Title &amp; more</h1></header>
<p>First para with <a href=x>link</a> words&nbsp;here.<div class="advert">Buy now!</div><p>Second <b>bold</b>face.<ul><li>one<li>two</ul>
<form><input><button>Send</button></form><!-- <p>no</p> --><section id="comments"><p>Reader says a long comment with many words in it.</p></section>
</article></main><aside><p>Sidebar text long long long long.</p></aside></div><footer>&copy; x</footer>"""


def test_extraction(spark):
    rows = [(1, PAGE), (2, None), (3, ""), (4, "<p>a short page without frame.</p>"), (5, "<article>" + "<div>" * 3000 + "deep text." + "x. " * 5000), (6, "<<>><p"), (1, PAGE)]
    out = collections.defaultdict(list)
    for r in htmlcut.extract(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, text string")).collect():
        out[r.page_id].append(r.text)
    assert out[1] == ["Title & more First para with link words here. Second boldface. one two"] * 2
    assert out[2] == out[3] == [""] and out[4] == ["a short page without frame."] and len(out[5][0]) > 14000
    assert htmlcut.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_frames_by_name():
    page = """<body class="single with-ads"><div class="page has-sidebar"><div class="site-header"><p>A site about many things, daily.</p></div>
<ul class="breadcrumb"><li>Home</li></ul><div class="post-content"><h2>Heading of it</h2><p>The first paragraph of the story is here.</p>
<figure><figcaption>A caption.</figcaption></figure><blockquote>A quotation in it.</blockquote><div class="shareButtons">Share this</div>
<p>The last one.</p></div><section class="related posts"><p>Other stories you may want to read today.</p></section>
<div id="comment-list"><article class="comment"><p>I liked this very much, thank you all.</p></article></div>
<noscript>Please switch scripts on.</noscript></div><div class="modal"><p>Subscribe to our letter now.</p></div></body>"""
    assert htmlcut.main_text(page)[0] == ("Heading of it The first paragraph of the story is here. A caption. A quotation in it. The last one.")


STORY = "<h1>Heading of the story</h1><p>The first paragraph of the story is here, long enough to be one.</p><p>The second one ends it.</p>"
PLAIN = "Heading of the story The first paragraph of the story is here, long enough to be one. The second one ends it."
MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy this now.</div>'


@pytest.mark.parametrize("wrapper", ['<div class="content-sidebar-wrap"><main>{}</main></div>', '<div class="page-with-sidebar"><article>{}</article></div>',
                                     '<form id="aspnetForm"><article>{}</article></form>', '<div id="legal"><article>{}</article></div>',
                                     '<form id="form1"><div id="content">{}</div></form>', '<div class="paywall"><article class="post tags-a">{}</article></div>'.replace("tags-a", "story")])
def test_a_wrapper_does_not_lose_the_article(wrapper):
    assert htmlcut.main_text(f"<body>{MENU}{wrapper.format(STORY)}<footer>All rights reserved.</footer></body>")[0] == PLAIN


def test_teasers_and_comments_beside_the_article_stay_out():
    page = (f'<body>{MENU}<main><article>{STORY}</article></main><div class="sidebar"><article><h3>Another story</h3><p>It tells of something else, read it now.</p></article></div>'
            '<div id="comments"><article class="media"><p>I liked this very much, thank you all.</p></article></div>'
            '<div class="notice"><p>We use cookies on this page.</p></div></body>')
    assert htmlcut.main_text(page)[0] == PLAIN


def test_the_cut_turns_doubtful_blocks_with_their_neighbours():
    items = "".join(f"<li><a href='/{k}'>Source number {k} of the story</a></li>" for k in range(3))
    page = f"<body>{MENU}<article>{STORY}<p>The sources of it are listed below, with links to each of them:</p><ul>{items}</ul><p>These were read in full by the author of this story.</p></article></body>"
    blocks, values, labels = htmlcut.labelled(page)
    turned = [b.text for b, v, x in zip(blocks, values, labels) if (v > 0) != x]
    assert turned == [f"Source number {k} of the story" for k in range(3)] and htmlcut.main_text(page)[3] == 3
    alone = [x for v, x in zip(values, htmlcut.minimum_cut(values, [])) if (v > 0) != x]
    assert alone == []
    lone = f"<body>{MENU}<article>{STORY}</article><p>See</p><ul><li><a href='/x'>Other</a></li><li><a href='/y'>Pages</a></li></ul></body>"
    assert htmlcut.main_text(lone)[0] == PLAIN


def test_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(1500):
        n = rng.randint(1, 8)
        value = [rng.choice([-2, -1, -.5, .3, .7, 1.5]) * rng.random() for _ in range(n)]
        edges = [(a, b, rng.random()) for a in range(n) for b in range(a + 1, n) if rng.random() < .5]
        cost = lambda labels: sum(abs(v) for v, x in zip(value, labels) if (v > 0) != x) + sum(w for a, b, w in edges if labels[a] != labels[b])
        assert cost(htmlcut.minimum_cut(value, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))
