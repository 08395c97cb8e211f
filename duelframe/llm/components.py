"""Connected components of links between numbers, and joins that a hot key doesn't hold up.

Links are first joined within tasks: a task's links come down to one per node, to the smallest node that its own
links lead to. What is left is drawn together in rounds. In a round every node that has a smaller neighbour hands
its larger ones on to the smallest (large star), and links are joined within tasks by their larger node (small
star, and whatever else the task holds). As a task has one link per node at most, no node has more smaller
neighbours than there are tasks; the larger neighbours of a hub, which may be any number, are looked up through a
small broadcast table. Any grouping of links is valid for joining them in a task, so memory is bounded by pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import stored

#: Links that are joined in one piece.
PIECE = 1_000_000
#: Keys that may be broadcast as hot: their rows are a share of one in HOT_KEYS, so there are no more of them.
HOT_KEYS = 10_000
#: Rows below which no key is hot.
HOT_ROWS = 1_000


def join_counted(rows: DataFrame, table: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """`rows` with the columns of `table`, which has one row per key and in `n` the number of rows with that key.

    Rows of hot keys find their row in a broadcast table of HOT_KEYS rows at most; all others meet in a shuffle, where
    no key has more than HOT_ROWS rows or a share of one in HOT_KEYS. `rows` is read twice if there are hot keys.
    """
    keys = list(keys)
    total, most = table.agg(F.sum(n), F.max(n)).first()
    limit = max(HOT_ROWS, (total or 0) // HOT_KEYS + 1)
    if (most or 0) < limit:
        return rows.hint("merge").join(table.hint("merge"), keys)
    hot = F.broadcast(table.where(F.col(n) >= limit))
    cold = rows.join(F.broadcast(table.where(F.col(n) >= limit).select(*keys)), keys, "left_anti").hint("merge").join(table.where(F.col(n) < limit).hint("merge"), keys)
    return rows.join(hot, keys).unionByName(cold)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the nodes that the links join, each that isn't the smallest of its component, and that smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        x, y = parent[i], parent[j]
        apart = x != y
        if not apart.any():
            moved = parent != np.arange(len(nodes))
            return nodes[moved], nodes[parent[moved]]
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(above := parent[parent], parent):
            parent = above


def _contracted(edges: DataFrame) -> DataFrame:
    """Links (u, v), v the smaller, that join what `edges` join, one per node of a task or piece."""

    def contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for frame in frames:
            u, v = forest(np.concatenate([u, frame["u"].to_numpy()]), np.concatenate([v, frame["v"].to_numpy()]))
            if len(u) > PIECE:
                yield pd.DataFrame({"u": u, "v": v})
                u, v = u[:0], v[:0]
        yield pd.DataFrame({"u": u, "v": v})

    return edges.mapInPandas(contract, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """node, root: for the links (a, b) of whole numbers, each node that isn't the smallest of its component, and that smallest one.

    Links of a node to itself and repeated ones change nothing; no links give no rows; nulls are not allowed.
    """
    edges = _contracted(links.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")))
    edges = stored(_contracted(edges.repartition("u")), "edges")
    while True:
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("other")))
        smaller = F.when(F.col("other") < F.col("node"), F.col("other"))
        around = both.groupBy("node").agg(F.min(smaller).alias("low"), F.max(smaller).alias("high"), F.max("other").alias("most"), F.count_if(F.col("other") > F.col("node")).alias("n"))
        around = stored(around, "around")
        if around.where("low < high or (low is not null and most > node)").isEmpty():  # nothing but stars
            return around.where("low is not null").select("node", F.col("low").alias("root"))
        target = around.where("n > 0").select(F.col("node").alias("v"), F.coalesce("low", "node").alias("to"), "n")
        edges = join_counted(edges, target, ["v"]).select("u", F.col("to").alias("v"))
        edges = stored(_contracted(edges.repartition("u")), "edges")
