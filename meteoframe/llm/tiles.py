"""Exact comparison of all pairs within pools, in tiles of two bounded blocks.

A pool may hold a third of all rows: its members are cut into blocks, every
wanted pair of blocks is a tile, and a tile gives link counts and a spanning
forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import slices

#: Index pairs of payloads that are linked, one index from each side.
Match = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def compare(placed: DataFrame, tiles: DataFrame, payloads: DataFrame, match: Match) -> DataFrame:
    """Links of ``placed`` (``node, component, block, weight``) over ``tiles``
    (``component, i, j`` with i <= j), by ``match`` on ``payloads`` (``node,
    payload``): columns ``a, b, links``.

    A row with b null adds links to node a (each partner by its weight); a row
    with b is an edge of the tile's spanning forest.
    """
    wanted = (tiles.select("component", "i", "j", F.col("i").alias("block"))
              .unionByName(tiles.where("i < j").select("component", "i", "j", F.col("j").alias("block"))))
    held = (placed.select("node", "component", "block", "weight").join(wanted, ["component", "block"])
            .join(payloads.select("node", "payload"), "node").select("component", "i", "j", "block", "node", "weight", "payload"))

    def tile(key: tuple, rows: list) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[1])                      # by node
        block = np.array([r[0] for r in rows])
        left, right = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
        x, y = match([r[3] for r in rows], left, right)
        if key[1] == key[2]:
            x, y = x[x < y], y[x < y]
        weight = np.array([r[2] for r in rows], float)
        links = np.bincount(x, weight[y], len(rows)) + np.bincount(y, weight[x], len(rows))
        node = np.array([r[1] for r in rows])
        root = list(range(len(rows)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        forest = []
        for p, q in zip(x.tolist(), y.tolist()):
            a, b = find(p), find(q)
            if a != b:
                root[max(a, b)] = min(a, b)
                forest.append((p, q))
        some = np.flatnonzero(links)
        a = [*node[some].tolist(), *(int(node[p]) for p, _ in forest)]
        b = [*[None] * len(some), *(int(node[q]) for _, q in forest)]
        n = [*links[some].astype(int).tolist(), *[0] * len(forest)]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for b in slices(batches, "payload"):
            for c, i, j, *row in zip(*(b.column(k).to_pylist() for k in range(7))):
                if (c, i, j) != at:
                    if len(rows) > 1:
                        yield tile(at, rows)
                    at, rows = (c, i, j), []
                rows.append(row)
        if len(rows) > 1:
            yield tile(at, rows)

    order = ["component", "i", "j"]
    return held.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long, links long")
