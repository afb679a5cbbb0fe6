"""Near-duplicate embeddings by NN-descent.

Equal vectors form one class.  Neighbour lists start from random-hyperplane
buckets and are refined by joins through neighbours of neighbours: whoever
stands in one list, or has it in theirs, is compared with each other.  A list
that is full of links is saturated: its node's pool (what links connect) then
takes the list's place and is compared whole, in tiles of bounded blocks, and
with every other vector that its blocks' centres and radii let within reach.
A bounded audit against brute force measures recall; while it is below target
more attempts follow, and at last all blocks are compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteoframe.llm import tiles as tiles_
from meteoframe.llm.common import lean, stored
from meteoframe.llm.components import connected

BLOCK = 512              # rows of a bucket compared with each other
ALWAYS = 2               # neighbours that a row of a group takes whatever their cosine
TILE_ROWS = 1024
AUDIT_ROWS = 1024
PAIR = "a long, b long, sim double, link boolean"


@dataclass
class NearDuplicates:
    """``rows``: vec_id, n_links, component_id, kept; ``recall``: as audited, or
    1 where all was compared."""

    rows: DataFrame
    recall: float


def unit(payloads: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(p, "<f8") for p in payloads])
    return x / np.sqrt((x * x).sum(1))[:, None]


def best_pairs(node: np.ndarray, x: np.ndarray, threshold: float, floor: float, size: int) -> pa.RecordBatch:
    """Each row's best ``size`` others of a group from ``floor`` on, and its best
    ``ALWAYS`` whatever their cosine: lists fill up where all is far.  Marked
    ``link``: a spanning forest of all the group's links, whoever is best."""
    s = x @ x.T
    np.fill_diagonal(s, -2)
    k = min(size, len(node) - 1)
    top = np.argpartition(-s, k - 1, 1)[:, :k]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), 1), 1)
    a = np.repeat(np.arange(len(node)), k)
    b = top.ravel()
    good = (s[a, b] >= floor) | (np.tile(np.arange(k), len(node)) < ALWAYS)
    near = s >= threshold
    fresh, forest = near.any(1), []
    while fresh.any():
        reached = [int(np.argmax(fresh))]
        fresh[reached[0]] = False
        for u in reached:
            more = np.flatnonzero(near[u] & fresh)
            fresh[more] = False
            forest += [(u, int(v)) for v in more]
            reached += more.tolist()
    p, q = np.array(forest, np.int64).reshape(-1, 2).T
    a, b, link = np.concatenate([a[good], p]), np.concatenate([b[good], q]), np.repeat([False, True], [good.sum(), len(p)])
    return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b]), pa.array(s[a, b]), pa.array(link)], names=["a", "b", "sim", "link"])


def within_groups(rows: DataFrame, threshold: float, floor: float, size: int, most: int) -> DataFrame:
    """``group, node, payload`` in order of group: pairs within each group, which
    is compared in runs of at most ``most`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, payloads = None, [], []
        for b in batches:
            for g, n, p in zip(*(b.column(c).to_pylist() for c in ("group", "node", "payload"))):
                if g != at or len(nodes) == most:
                    if len(nodes) > 1:
                        yield best_pairs(np.array(nodes), unit(payloads), threshold, floor, size)
                    at, nodes, payloads = g, [], []
                nodes.append(n)
                payloads.append(p)
        if len(nodes) > 1:
            yield best_pairs(np.array(nodes), unit(payloads), threshold, floor, size)

    return rows.mapInArrow(run, PAIR)


def choose_tables(count: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits and number of hash tables: buckets of about half a block, and two
    vectors at ``threshold`` share one with probability ``recall`` or more."""
    bits = max(1, int(np.ceil(np.log2(max(count, 2) / (BLOCK / 2)))))
    share = (1 - np.arccos(threshold) / np.pi) ** bits
    return bits, max(1, int(np.ceil(np.log1p(-recall) / np.log1p(-share))))


def seed_pairs(vectors: DataFrame, bits: int, tables: int, seed: int, threshold: float, floor: float, size: int) -> DataFrame:
    """Pairs from ``tables`` hyperplane hashings of ``bits`` bits, and from one
    by chance as NN-descent's random neighbours."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            nodes, payloads = b.column("node").to_pylist(), b.column("payload").to_pylist()
            out = []
            for dim in sorted({len(p) for p in payloads}):
                own = [i for i, p in enumerate(payloads) if len(p) == dim]
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).normal(size=(dim // 8, tables * bits))
                signs = (unit([payloads[i] for i in own]) @ planes[dim] > 0).reshape(len(own), tables, bits)
                code = (signs << np.arange(bits)).sum(2)
                chance = (np.array([nodes[i] for i in own]).astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
                code = np.column_stack([code, (chance >> np.uint64(64 - bits)).astype(np.int64)])
                out += [(f"{dim} {t} {code[k, t]}", nodes[i], payloads[i]) for k, i in enumerate(own) for t in range(tables + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], pa.binary())], names=["group", "node", "payload"])

    rows = vectors.select("node", "payload").mapInArrow(codes, "group string, node long, payload binary")
    # by range, with the id's hash behind the bucket: a bucket holding a third of all rows spreads over many tasks,
    # and is cut into other runs in each table
    rows = rows.withColumn("salt", F.xxhash64("node", "group")).repartitionByRange("group", "salt").sortWithinPartitions("group", "salt")
    return within_groups(rows, threshold, floor, size, BLOCK)


def top_lists(pairs: DataFrame, size: int) -> DataFrame:
    """The best ``size`` distinct neighbours of each node."""
    both = pairs.select("a", "b", "sim").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    distinct = both.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return distinct.withColumn("r", rank).where(F.col("r") <= size).drop("r")


def descend(lists: DataFrame, vectors: DataFrame, threshold: float, floor: float, size: int) -> DataFrame:
    """Pairs of one round: the members of each node's list, and up to ``size``
    nodes whose lists hold it, are compared with each other."""
    back = lists.select(F.col("b").alias("group"), F.col("a").alias("node"), "sim")
    rank = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("sim"), "node"))
    back = back.withColumn("r", rank).where(F.col("r") <= size).select("group", "node")
    members = lists.select(F.col("a").alias("group"), F.col("b").alias("node")).unionByName(back).distinct()
    rows = members.join(vectors.select("node", "payload"), "node").select("group", "node", "payload")
    return within_groups(rows.repartition("group").sortWithinPartitions("group", "node"), threshold, floor, size, 4 * size)


def in_blocks(vectors: DataFrame, pools: DataFrame, count: int, size: int) -> DataFrame:
    """All vectors in blocks of about ``TILE_ROWS``, one row each: pools of over
    ``size`` members in blocks of their own (``full``), the others mixed."""
    full = pools.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size)
    rows = (vectors.select("node", "payload").join(pools.select("node", "component"), "node", "left")
            .join(full, "component", "left"))
    share = F.pmod(F.xxhash64("node"), F.ceil(F.coalesce("n", F.lit(count)) / F.lit(TILE_ROWS * 0.9)))
    name = F.concat_ws(" ", F.octet_length("payload"), F.when(F.col("n").isNotNull(), F.col("component").cast("string")).otherwise("-"), share)
    rows = rows.select(name.alias("block"), F.col("n").isNotNull().alias("full"), "node",
                       F.coalesce("component", F.lit(-1)).alias("component"), "payload")

    def pack(block: str, full: bool, held: list) -> pa.RecordBatch:
        x = unit([r[2] for r in held])
        centre = x.sum(0)
        centre = centre / max(np.sqrt(centre @ centre), 1e-300)
        reach = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([full]), pa.array([held[0][1]], pa.int64()), pa.array([x.shape[1]], pa.int32()), pa.array([np.array([r[0] for r in held], "<i8").tobytes()]),
             pa.array([np.array([r[1] for r in held], "<i8").tobytes()]), pa.array([x.tobytes()]), pa.array([centre.tobytes()]), pa.array([reach])],
            names=["block", "full", "pool", "dim", "nodes", "pools", "x", "centre", "reach"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last, held = None, (), []
        for b in batches:
            for block, full, *row in zip(*(b.column(k).to_pylist() for k in range(5))):
                if block != at:
                    if held:
                        yield pack(*last, held)
                    at, last, held = block, (block, full), []
                held.append(row)
        if held:
            yield pack(*last, held)

    packed = rows.repartition("block").sortWithinPartitions("block", "node").mapInArrow(
        run, "block string, full boolean, pool long, dim int, nodes binary, pools binary, x binary, centre binary, reach double")
    return stored(packed, "descent-packs")


def within_reach(blocks: DataFrame, threshold: float) -> DataFrame:
    """``p, q``: blocks p with a vector that may link with one of the full block q
    of another pool.  Angles add up at most, so no link is left out."""
    names = blocks.where("full").select("dim", F.col("block").alias("q"), "pool", "centre", "reach")
    centres = (names.groupBy("dim", F.pmod(F.xxhash64("q"), F.lit(max(1, names.count() // TILE_ROWS))).alias("part"))
               .agg(F.collect_list(F.struct("q", "pool", "centre", "reach")).alias("full_ones")))
    reach = float(np.arccos(threshold)) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, full, dim, pools, raw, ones in zip(*(b.column(k).to_pylist() for k in range(6))):
                x, own = np.frombuffer(raw, "<f8").reshape(-1, dim), np.frombuffer(pools, "<i8")
                c = np.stack([np.frombuffer(o["centre"], "<f8") for o in ones])
                angle = np.arccos(np.clip(x @ c.T, -1, 1))
                near = (angle <= np.array([o["reach"] for o in ones]) + reach) & (own[:, None] != np.array([o["pool"] for o in ones]))
                q = [ones[k]["q"] for k in np.flatnonzero(near.any(0)) if not full or ones[k]["q"] > p]
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(q), pa.string()), pa.array(q, pa.string())], names=["p", "q"])

    rows = blocks.select(F.col("block").alias("p"), "full", "dim", "pools", "x").join(centres.select("dim", "full_ones"), "dim").select("p", "full", "dim", "pools", "x", "full_ones")
    # of two full blocks one side's view suffices
    return rows.mapInArrow(run, "p string, q string")


def links_across(blocks: DataFrame, wanted: DataFrame, threshold: float) -> DataFrame:
    """For the wanted pairs of blocks, one link of each two pools (or lone nodes)
    that have any: ``a, b``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, n1, p1, x1, n2, p2, x2 in zip(*(b.column(k).to_pylist() for k in range(7))):
                (n1, p1), (n2, p2) = ((np.frombuffer(n, "<i8"), np.frombuffer(p, "<i8")) for n, p in ((n1, p1), (n2, p2)))
                near = np.frombuffer(x1, "<f8").reshape(-1, dim) @ np.frombuffer(x2, "<f8").reshape(-1, dim).T >= threshold
                near &= ((p1[:, None] != p2) | (p1[:, None] < 0)) & (n1[:, None] != n2)
                i, j = np.nonzero(near)
                # a lone node counts as a pool of its own
                ends = np.stack([np.where(p1[i] < 0, -1 - n1[i], p1[i]), np.where(p2[j] < 0, -1 - n2[j], p2[j])], 1)
                first = np.unique(ends, axis=0, return_index=True)[1] if len(i) else i
                yield pa.RecordBatch.from_arrays([pa.array(n1[i[first]]), pa.array(n2[j[first]])], names=["a", "b"])

    left = blocks.select("dim", F.col("block").alias("p"), F.col("nodes").alias("n1"), F.col("pools").alias("p1"), F.col("x").alias("x1"))
    right = blocks.select(F.col("block").alias("q"), F.col("nodes").alias("n2"), F.col("pools").alias("p2"), F.col("x").alias("x2"))
    both = wanted.join(left, "p").join(right, "q").select("dim", "n1", "p1", "x1", "n2", "p2", "x2")
    return both.mapInArrow(run, "a long, b long")


def pools_of(links: DataFrame) -> DataFrame:
    """``node, component`` of all linked nodes."""
    return stored(connected(links).withColumnRenamed("root", "component"), "descent-pools")


def audit(vectors: DataFrame, pools: DataFrame, threshold: float) -> float:
    """Of a bounded chance sample of nodes, found links or not: among those with
    a true link, the share whose every true link lies in their own pool."""
    placed = vectors.select("node", "payload").join(pools.select("node", "component"), "node", "left")
    chosen = placed.sort(F.xxhash64("node", F.lit(1))).limit(AUDIT_ROWS).collect()
    by_dim: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for dim in {len(r.payload) for r in chosen}:
        own = [r for r in chosen if len(r.payload) == dim]
        by_dim[dim] = (np.array([r.node for r in own]), np.array([-1 if r.component is None else r.component for r in own]),
                       unit([r.payload for r in own]))

    def true_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, payloads, pool = (b.column(k).to_pylist() for k in ("node", "payload", "component"))
            for dim, (names, theirs, x) in by_dim.items():
                own = [i for i, p in enumerate(payloads) if len(p) == dim]
                if own:
                    node = np.array([nodes[i] for i in own])
                    mine = np.array([-2 if pool[i] is None else pool[i] for i in own])
                    true = (unit([payloads[i] for i in own]) @ x.T >= threshold) & (node[:, None] != names)
                    lost = true & (mine[:, None] != theirs)
                    some = np.flatnonzero(true.any(0))
                    yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(lost.any(0)[some])], names=["node", "lost"])

    seen = placed.mapInArrow(true_links, "node long, lost boolean").groupBy("node").agg(F.max("lost").alias("lost"))
    total, lost = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("lost").cast("int")), F.lit(0))).first()
    return 1 - lost / total if total else 1.0


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9,
                    size: int = 16, floor: float = 0.6, tables: int | None = None, rounds: int = 3,
                    target: float = 0.99, most_tries: int = 3, seed_recall: float = 0.999) -> NearDuplicates:
    """Links between vectors of cosine ``threshold`` or more, in double precision.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; vectors of different lengths never link.  Lists hold the
    best neighbours met, however far; from ``floor`` on a group gives each row
    ``size`` of them.  An attempt has as many hash ``tables`` as two vectors at
    ``threshold`` need to meet with ``seed_recall``.  ``n_links`` counts other rows
    directly linked; ``component_id`` is the smallest id reachable.  Repeated
    rows are rows each; a row without id links with nothing and has a null
    component.  An empty table gives an empty table.
    """
    v, i = F.col(f"`{embedding}`"), F.col(f"`{vec_id}`").cast("long")
    plain = lean(df).select(i.alias("vec_id"), v.cast("array<double>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)      # null where a component is
    rows = stored(plain.withColumn("norm", norm).withColumn(
        "v", F.when((F.col("norm") > 0) & (F.col("norm") < float("inf")) & F.col("vec_id").isNotNull(), F.col("v"))).drop("norm"), "descent-rows")
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads = [np.asarray(x, "<f8").tobytes() for x in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(payloads, pa.binary())], names=["v", "rep", "weight", "payload"])

    vectors = classes.mapInArrow(packed, "v array<double>, rep long, weight long, payload binary")
    vectors = stored(vectors.withColumn("node", F.monotonically_increasing_id()), "descent-vectors")
    count = vectors.count()

    bits, enough = choose_tables(count, threshold, seed_recall)
    lists = links = None
    pools = df.sparkSession.createDataFrame([], "node long, component long")
    for attempt in range(most_tries):
        pairs = stored(seed_pairs(vectors, bits, tables or enough, 11 + attempt, threshold, floor, size), "descent-pairs")
        new = pairs.where("link").select("a", "b")        # of every link found, not only those that lists hold
        links = new if links is None else links.unionByName(new)
        lists = stored(top_lists(pairs if lists is None else lists.unionByName(pairs.drop("link")), size), "descent-lists")
        for _ in range(rounds):
            was, pairs = lists, stored(descend(lists, vectors, threshold, floor, size), "descent-pairs")
            links = links.unionByName(pairs.where("link").select("a", "b"))
            lists = stored(top_lists(lists.unionByName(pairs.drop("link")), size), "descent-lists")
            if not lists.join(was, ["a", "b"], "left_anti").where(F.col("sim") >= threshold - 0.1).head(1):
                break
        pools = pools_of(links)
        blocks = in_blocks(vectors, pools, count, size)
        across = stored(links_across(blocks, within_reach(blocks, threshold), threshold), "descent-across")
        if across.head(1):
            links = links.unionByName(across)
            pools = pools_of(links)
        recall = audit(vectors, pools, threshold)
        if recall >= target:
            break
    else:                            # no attempt got there: every block with every other
        blocks = in_blocks(vectors, pools, count, size)
        names = blocks.select(F.col("block").alias("p"), "dim")
        every = names.join(names.withColumnRenamed("p", "q"), "dim").where("p <= q").select("p", "q")
        rest = stored(links_across(blocks, every, threshold), "descent-rest")
        pools, recall = pools_of(rest if links is None else links.unionByName(rest)), 1.0

    # a list with room holds all of its node's links; a full one gives way to the whole pool
    own = pools.join(vectors.select("node", "weight", "rep"), "node")
    placed = stored(own.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("component").orderBy("node")) - 1) / TILE_ROWS).cast("int")), "descent-blocks")
    last = placed.groupBy("component").agg(F.max("block").alias("last"))
    tiles = (last.withColumn("i", F.explode(F.sequence(F.lit(0), "last"))).withColumn("j", F.explode(F.sequence("i", "last")))
             .select("component", F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j")))

    def match(payloads: list[bytes], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = unit(payloads)
        p, q = np.nonzero(x[left] @ x[right].T >= threshold)
        return left[p], right[q]

    found = tiles_.compare(placed, tiles, vectors, match).where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
    named = placed.groupBy("component").agg(F.min("rep").alias("smallest"))
    by_class = (vectors.join(pools, "node", "left").join(named, "component", "left").join(found, "node", "left")
                .select("v", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                        F.coalesce("smallest", "rep").alias("component_id")))
    linked = rows.where("v IS NOT NULL").join(by_class, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return NearDuplicates(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), recall)
