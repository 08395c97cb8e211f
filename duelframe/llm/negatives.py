"""Hard negatives by Fagin's threshold algorithm.

An anchor's score of a row is their inner product, a sum over the dimensions, so rows can be searched through one
sorted list per dimension: from its top where the anchor is positive, from its bottom where it is negative. Sorted
access reads all lists to the same depth. A row seen for the first time is scored as a whole, in whole numbers
(random access). What the anchor would score with the values the lists have come to is the threshold: no row that is
still unseen scores more. The search ends once the threshold is strictly below the k-th best score that is asked for;
at an equal score an unseen row with a smaller id might still come before.

Rows and anchors are dealt to blocks of bounded size, and every block of anchors meets every block of rows in a task of
its own, which has the sorted lists of its block. First each anchor's positives are searched, then for the windows of
scores that they set, the negatives. The best of the blocks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import stored
from duelframe.operators.grouping import top_rows_per_group

POSITIVES, NEGATIVES = 5, 5
#: Rows and anchors per block.
ROWS, ANCHORS = 8192, 4096
#: Depth of the first sorted access, and how much deeper each next one goes.
DEPTH, DEEPER = 16, 4
#: Share of a positive's score, in hundredths, that a negative must have.
FLOOR = 80
#: Components after scaling are below this; scores of vectors of up to 2048 of them are exact then.
LARGEST = 1 << 26


def vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, v (whole numbers) and row (a hash of these) of the rows that take part, each different row once."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    whole = F.col("embedding").cast("array<double>")
    plain = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    kept = embeddings.where(F.col("label").isNotNull() & whole.isNotNull() & plain)
    scaled = F.transform(whole, lambda x: F.when(F.abs(x) < LARGEST / 256, F.floor(x * 256)).otherwise(F.raise_error(F.lit(f"a component of {LARGEST // 256} or more"))))
    found = kept.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), scaled.cast("array<int>").alias("v"))
    return found.distinct().withColumn("row", F.xxhash64("vec_id", "label", "v"))


def _table(column: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for row, v in zip(out, column, strict=True):
        row[: len(v)] = v
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both tables as numbers in which their inner products are exact; floats where that will do, as they are faster."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return a.astype(kind), b.astype(kind)


class Lists:
    """Sorted lists of a table's dimensions, for searches by an anchor."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.order = np.argsort(table, axis=0, kind="stable").T.copy()  # rising, a line per dimension
        self.sorted = np.take_along_axis(table.T, self.order, axis=1)

    def search(self, anchor: np.ndarray, enough: Callable[[np.ndarray, np.ndarray, float], bool]) -> tuple[np.ndarray, np.ndarray]:
        """Rows seen and their scores, once `enough(rows, scores, threshold)`, or once all are seen."""
        n = len(self.table)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        scores, seen = np.zeros(n, self.table.dtype), np.zeros(n, bool)
        at, depth = 0, DEPTH
        while at < n and len(up) + len(down):
            to = min(n, depth)
            new = np.zeros(n, bool)
            new[self.order[up, n - to : n - at].ravel()] = True
            new[self.order[down, at:to].ravel()] = True
            new &= ~seen
            rows = np.flatnonzero(new)
            scores[rows] = self.table[rows] @ anchor
            seen |= new
            at, depth = to, depth * DEEPER
            threshold = anchor[up] @ self.sorted[up, n - to] + anchor[down] @ self.sorted[down, to - 1]
            if seen.all() or enough(np.flatnonzero(seen), scores[seen], threshold):
                return np.flatnonzero(seen), scores[seen]
        return np.arange(n), self.table @ anchor  # a zero anchor: all scores are equal, and no list says anything


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, best first, equal ones by id."""
    if len(scores) > 4 * k + 16:
        some = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _ids(column: pd.Series) -> np.ndarray:
    """Ids as numbers, a null after all others."""
    return np.array([np.iinfo(np.int64).max if x is None or x != x else x for x in column], np.int64)


def _dealt(rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the blocks i (of anchors) and j (of rows), each row once per block of the other side."""
    most_i = -(-max(1, anchors.count()) // ANCHORS)
    most_j = -(-max(1, rows.count()) // ROWS)
    block = lambda n: F.pmod("row", F.lit(n)).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return rows.withColumns({"j": block(most_j)}).withColumn("i", other(most_i)), anchors.withColumns({"i": block(most_i)}).withColumn("j", other(most_j))


def _met(rows: DataFrame, anchors: DataFrame, find, schema: str) -> DataFrame:
    """What `find` gives for each block of anchors with each block of rows."""
    a, b = _dealt(rows, anchors)
    return a.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInPandas(find, schema)


def _prepared(rows: pd.DataFrame, anchors: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    width = max(max(map(len, rows["v"]), default=0), max(map(len, anchors["v"]), default=0))
    return _exact(_table(rows["v"], width), _table(anchors["v"], width))


def positives(rows: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """anchor_id, anchor (its `row`), positive_id, positive_score: the k best other rows of the anchor's label, or all.

    Rows and anchors are as `vectors` gives them.
    """

    def find(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(found) and len(asked):
            table, wanted = _prepared(found, asked)
            ids, labels = _ids(found["vec_id"]), found["label"].to_numpy()
            for label, places in asked.groupby("label").indices.items():
                here = np.flatnonzero(labels == label)
                lists, mine = Lists(table[here]), ids[here]
                for p in places:
                    own = int(asked["vec_id"].iat[p])

                    def enough(seen, scores, threshold, mine=mine, own=own):
                        scores = scores[mine[seen] != own]
                        return len(scores) >= k and threshold < np.partition(scores, -k)[-k]

                    seen, scores = lists.search(wanted[p], enough)
                    other = mine[seen] != own
                    seen, scores = seen[other], scores[other]
                    out += [(own, asked["row"].iat[p], found["vec_id"].iat[here[seen[x]]], int(scores[x])) for x in _first(mine[seen], scores, k)]
        return pd.DataFrame(out, columns=["anchor_id", "anchor", "positive_id", "positive_score"])

    best = _met(rows, anchors, find, "anchor_id long, anchor long, positive_id long, positive_score long")
    order = [F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last()]
    return top_rows_per_group(best, ["anchor_id", "anchor"], order, k, "_n").drop("_n")


def _least(score: int) -> int:
    """Least score of a negative beside a positive with this one."""
    return -(-FLOOR * int(score) // 100)


def negatives(rows: DataFrame, anchors: DataFrame, found: DataFrame, k: int = NEGATIVES) -> DataFrame:
    """Rows of `found` (as `positives` gives them) with rank, negative_id, negative_score: the k best rows of another label within the window."""
    windows = found.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor").alias("row")).agg(
        F.collect_set("positive_score").alias("windows")  # as many as there are positives at most
    )
    asked = stored(anchors.join(windows, ["vec_id", "row"]), "windows")

    def find(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(asked):
            table, wanted = _prepared(rows, asked)
            ids, labels = _ids(rows["vec_id"]), rows["label"].to_numpy()
            lists = Lists(table)
            for p in range(len(asked)):
                windows = [(_least(x), int(x)) for x in asked["windows"].iat[p] if _least(x) <= x]
                if not windows:
                    continue
                other = labels != asked["label"].iat[p]

                def enough(seen, scores, threshold, other=other, windows=windows):
                    scores = scores[other[seen]]
                    for least, most in windows:
                        if threshold < least:
                            continue  # nothing unseen is in the window
                        within = scores[(scores >= least) & (scores <= most)]
                        if len(within) < k or threshold >= np.partition(within, -k)[-k]:
                            return False
                    return True

                seen, scores = lists.search(wanted[p], enough)
                seen, scores = seen[other[seen]], scores[other[seen]]
                for least, most in windows:
                    at = np.flatnonzero((scores >= least) & (scores <= most))
                    for x in at[_first(ids[seen[at]], scores[at], k)]:
                        out.append((asked["vec_id"].iat[p], asked["row"].iat[p], most, rows["vec_id"].iat[seen[x]], int(scores[x])))
        return pd.DataFrame(out, columns=["anchor_id", "anchor", "positive_score", "negative_id", "negative_score"])

    best = _met(rows, asked, find, "anchor_id long, anchor long, positive_score long, negative_id long, negative_score long")
    window = ["anchor_id", "anchor", "positive_score"]
    ranked = top_rows_per_group(best, window, [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last()], k, "rank")
    return found.join(ranked, window).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(embeddings: DataFrame, anchor_every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors of `embeddings` (vec_id, embedding, label).

    Rows with a null label or vector, or a component that is null or not finite, take no part. Vectors shorter than others count as
    filled up with zeros; empty ones score 0. A component of 2^18 or more raises an error, since scores could leave the
    64 bits. A row without id is no anchor and comes after all others of its score. Repeated rows (the same id, label
    and vector) count once; different rows under one id all take part, but for an anchor rows of its own id are not others.
    Other columns are not read; no rows, no anchors or no row in a window give no rows.
    """
    rows = stored(vectors(embeddings), "vectors")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    return negatives(rows, anchors, stored(positives(rows, anchors), "positives"))
