"""Near-duplicate classes by DartMinHash over weighted five-word shingles.

Every shingle is an element, and its count in the text its weight. Darts are thrown by hashing: an element of
weight w is a strip of that height, and on each unit of it, along an axis of ranks, darts lie as a Poisson
process that depends on the element alone. A text keeps the darts that fall below its weights and below a
rank at which about k ln k + 2k darts are expected, which costs no more for heavier texts. Each dart belongs
to a hashed coordinate, and the earliest one per coordinate is the signature: two texts agree in a
coordinate as often as their weighted Jaccard similarity.

Bands of the signature are joined without ever listing the pairs of a bucket: each text is compared with one
pivot per bucket, exactly, by the shingles of both. In buckets that then still hold several classes,
signatures are compared block by block; what may be alike is gathered, and gathered texts are compared
exactly, block by block again. Blocks put out links that span what they join, never all pairs. So every
pair that shares a bucket either is in one class already or has been compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import stored, texts_of
from duelframe.llm.components import components

SIMILARITY = 0.8
WORDS = 5
#: A pair of similarity s shares a bucket with probability 1 - (1 - s^6)^36: 0.99998 at 0.8, 0.43 at 0.5.
BANDS, ROWS = 36, 6
COORDINATES = BANDS * ROWS
#: Texts of a bucket that are compared with each other in one piece.
BLOCK = 256
#: Share of equal coordinates below which a pair is not looked at exactly: five deviations under 0.8.
LEAST = 0.66
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_CELLS = 200_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def _times(n: int) -> np.uint64:
    return np.uint64(n * int(_C1) & ((1 << 64) - 1))


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers from 0 to below 1."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text's five-word shingles, rising, and their counts; all words if there are fewer, none if none."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    found = sum(_mix(each[i : len(each) - size + 1 + i] + _times(i + 1)) for i in range(size))
    values, counts = np.unique(found, return_counts=True)
    return values, counts.astype(float)


def _ranges(low: float, high: float) -> list[tuple[float, float, int]]:
    """Fixed intervals of the rank axis from `low` up to at least `high`: (start, length, number).

    [0, 4^-8), then each four times as far up to 1, then of length 1: the same for all texts.
    """
    edges = [(0.0, 4.0**-8, 0)] + [(4.0 ** (i - 9), 3 * 4.0 ** (i - 9), i) for i in range(1, 9)]
    found = [e for e in edges if e[0] >= low and e[0] < high]
    if high > 1:
        found += [(float(i), 1.0, 8 + i) for i in range(max(1, int(low)), int(np.ceil(high)))]
    return found


def signature(elements: np.ndarray, weights: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """Number of the earliest dart in each of k coordinates; `elements` are hashes, `weights` positive."""
    height = np.ceil(weights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), height)
    unit = np.arange(len(owner)) - np.repeat(np.cumsum(height) - height, height)
    top = np.minimum(1.0, weights[owner] - unit)
    cells = _mix(elements[owner] + unit.astype(np.uint64) * _C1)
    best, found = np.full(k, np.inf), np.zeros(k, np.uint64)
    low, high = 0.0, k * (np.log(k) + 2) / weights.sum()
    while np.isinf(best).any():
        spans = _ranges(low, high)
        start, length, number = (np.array(x) for x in zip(*spans, strict=True))
        for at in range(0, len(cells), _CELLS):
            _throw(cells[at : at + _CELLS], top[at : at + _CELLS], start, length, number.astype(np.uint64), best, found)
        low = float(start[-1] + length[-1])
        high = 2 * low if low >= 1 else 4 * low
    return found


def _throw(cells, top, start, length, number, best, found) -> None:
    """Darts of the cells in the given intervals of ranks; the earliest per coordinate stay in `best` and `found`."""
    areas = _mix(cells[:, None] + (number[None, :] + np.uint64(1)) * _C3)
    chance, n = _unit(areas), 0
    more = chance >= np.exp(-length)[None, :]
    term = np.exp(-length)
    total = term.copy()
    darts, cell, span = [], [], []
    while True:  # the n-th dart of all areas that have so many
        c, s = np.nonzero(more)
        if not len(c):
            break
        darts.append(_mix(areas[c, s] + _times(n + 1)))
        cell.append(c)
        span.append(s)
        n += 1
        term = term * length / n
        total = total + term
        if n > 40:
            break
        more &= chance >= total[None, :]
    if not darts:
        return
    dart, c, s = np.concatenate(darts), np.concatenate(cell), np.concatenate(span)
    under = _unit(_mix(dart + _C2)) < top[c]
    dart, s = dart[under], s[under]
    rank = start[s] + length[s] * _unit(_mix(dart + _C3))
    place = (dart % np.uint64(len(best))).astype(np.int64)
    first = np.full(len(best), np.inf)
    np.minimum.at(first, place, rank)
    wins = (rank == first[place]) & (rank < best[place])
    best[place[wins]], found[place[wins]] = rank[wins], dart[wins]


def bands(signed: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, which holds the band's number."""
    each = _mix(signed.reshape(BANDS, ROWS) + np.arange(1, ROWS + 1, dtype=np.uint64) * _C1)
    return _mix(each.sum(1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _C2).view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / max(1e-9, a[1].sum() + b[1].sum() - both))


def signed(documents: DataFrame) -> DataFrame:
    """doc_id, node (a 64-bit hash of the text, null as empty), keys of its bands, sketch of its signature."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, sketches = [], []
            for text in texts_of(frame["text"]):
                elements, weights = shingles(text)
                found = signature(elements, weights) if len(elements) else None
                keys.append([] if found is None else bands(found))
                sketches.append(b"" if found is None else (found >> np.uint64(48)).astype("<u2").tobytes())
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "node": frame["node"].to_numpy(), "keys": keys, "sketch": sketches})

    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", F.xxhash64(text).alias("node"), text.alias("text")).mapInPandas(sign, f"doc_id {kind}, node long, keys array<long>, sketch binary")


def shingle_table(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, values, counts: the shingles of the wanted nodes (node, first_id), each text read once.

    The wanted nodes may be any share of all, so they are never broadcast.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [shingles(x) for x in texts_of(frame["text"])]
            yield pd.DataFrame({"node": frame["node"].to_numpy(), "values": [v.tobytes() for v, _ in found], "counts": [c.astype("<u4").tobytes() if c.max() > 1 else b"" for _, c in found]})

    text = F.coalesce("text", F.lit(""))
    texts = documents.select(F.xxhash64(text).alias("node"), "doc_id", text.alias("text")).join(wanted.hint("merge"), "node")
    texts = texts.where(F.col("doc_id").eqNullSafe(F.col("first_id"))).select("node", "text").dropDuplicates(["node"])
    return stored(texts.mapInPandas(count, "node long, values binary, counts binary"), "shingles")


def _read(values: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(values, np.uint64)
    return found, np.frombuffer(counts, "<u4").astype(float) if counts else np.ones(len(found))


def verified(pairs: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """Those of the pairs of nodes (a, b) whose texts are alike, by all shingles of both."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            near = [similarity(_read(v, c), _read(w, d)) >= least for v, c, w, d in zip(frame["va"], frame["ca"], frame["vb"], frame["cb"], strict=True)]
            yield frame.loc[np.array(near, bool), ["a", "b"]]

    first = table.select(F.col("node").alias("a"), F.col("values").alias("va"), F.col("counts").alias("ca"))
    second = table.select(F.col("node").alias("b"), F.col("values").alias("vb"), F.col("counts").alias("cb"))
    joined = pairs.hint("merge").join(first, "a").hint("merge").join(second, "b")
    return stored(joined.select("a", "b", "va", "ca", "vb", "cb").mapInPandas(compare, "a long, b long"), "links")


def _blocks(members: DataFrame, group: str) -> DataFrame:
    """`members` (group, node, root) dealt to blocks of BLOCK nodes or so; every two blocks of a group meet as (i, j)."""
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("x"), F.max("root").alias("y"))
    sizes = sizes.where("x <> y").select(group, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))  # several classes only
    own = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int").alias("own")
    dealt = members.join(sizes, group).select(group, "node", "root", own, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return dealt.select(group, "node", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _spanning(node: np.ndarray, root: np.ndarray, own: np.ndarray, same_block: bool, near) -> pd.DataFrame:
    """Links between nodes that `near(r)` finds, as many as it takes to join what it joins, none within a class."""
    label = np.unique(root, return_inverse=True)[1]
    a, b = [], []
    for r in range(len(node) - 1):
        hit = near(r) & (label[r + 1 :] != label[r])
        if not same_block:
            hit &= own[r + 1 :] != own[r]
        at = r + 1 + np.flatnonzero(hit)
        if len(at):
            others, first = np.unique(label[at], return_index=True)
            a.append(np.full(len(others), node[r]))
            b.append(node[at[first]])
            label[np.isin(label, others)] = label[r]
    joined = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pd.DataFrame({"a": joined(a), "b": joined(b)})


def _candidates(rows: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) that join the texts of different classes which share a bucket and whose signatures may be alike."""
    members = rows.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = _blocks(members, "key").join(nodes.select("node", "sketch"), "node")

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        table = np.stack([np.frombuffer(x, "<u2") for x in frame["sketch"]])
        near = lambda r: (table[r + 1 :] == table[r]).mean(1) >= LEAST
        return _spanning(*(frame[c].to_numpy() for c in ("node", "root", "own")), bool(key[1] == key[2]), near)

    return placed.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _between_classes(candidates: DataFrame, roots: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """Verified links between classes: all texts that candidate links and classes join are compared exactly, in blocks."""
    groups = components(candidates.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "cluster")
    members = groups.join(roots, "node", "left").select("cluster", "node", F.coalesce("root", "node").alias("root"))
    placed = _blocks(members, "cluster").join(table, "node")

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _spanning(*(frame[c].to_numpy() for c in ("node", "root", "own")), bool(key[1] == key[2]), _exact(frame["values"], frame["counts"], least))

    return stored(placed.groupBy("cluster", "i", "j").applyInPandas(compare, "a long, b long"), "links")


def _exact(values: pd.Series, counts: pd.Series, least: float):
    """For row r, which later rows have a similarity of `least` or more: common shingles of all pairs by products of 0-1 tables."""
    units, owner = [], []
    for n, (v, c) in enumerate(_read(x, y) for x, y in zip(values, counts, strict=True)):
        copy = np.concatenate([np.arange(k) for k in c.astype(np.int64)]) if c.max(initial=1) > 1 else np.zeros(len(v), np.int64)
        units.append(_mix(np.repeat(v, c.astype(np.int64)) + copy.astype(np.uint64) * _C1))  # the k-th copy of a shingle
        owner.append(np.full(len(units[-1]), n))
    size = np.array([len(u) for u in units], dtype=float)
    unit, owner = np.concatenate(units), np.concatenate(owner)
    _, column, times = np.unique(unit, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(size), len(size)), dtype=np.float32)
    for first in range(0, int(column.max(initial=-1)) + 1, 4096):
        part = slice(*np.searchsorted(column, [first, first + 4096]))
        block = np.zeros((len(size), 4096), dtype=np.float32)
        block[owner[part], column[part] - first] = 1
        common += block @ block.T
    alike = common / np.maximum(1e-9, size[:, None] + size[None, :] - common.astype(float)) >= least
    return lambda r: alike[r, r + 1 :]


def near_duplicates(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, node, class_id (the smallest doc_id of its class) and kept (is it the class's own row) per row.

    A class holds texts linked by a weighted Jaccard similarity of `least` or more, and all copies of each.
    Null texts are empty; texts without a word are copies of each other only if equal. A text of fewer than
    five words is one shingle. Repeated rows are in one class; `kept` is true for all rows with the class's
    id and text. Null ids come after all others. Other columns are not read. Texts count as equal if their 64-bit hashes
    are: among a billion different texts one such mistake is expected in thirty corpora.
    """
    found = stored(signed(documents), "signed")
    nodes = stored(found.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.any_value("keys").alias("keys"), F.any_value("sketch").alias("sketch")), "nodes")
    rows = nodes.select("node", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("other")).where("pivot <> other").select("key", "pivot")
    rows = stored(rows.join(shared, "key"), "buckets")
    table = shingle_table(documents, rows.select("node").distinct().join(nodes.select("node", "first_id"), "node"))
    pairs = rows.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = verified(pairs, table, least)
    roots = components(links)
    candidates = stored(_candidates(rows, nodes, roots), "candidates")
    if not candidates.isEmpty():
        roots = components(links.unionByName(_between_classes(candidates, roots, table, least)))
    placed = nodes.select("node", "first_id").join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    classes = placed.groupBy("root").agg(F.min("first_id").alias("class_id"), F.min_by("node", F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("class_node"))
    placed = placed.join(classes, "root").select("node", "class_id", "class_node", "root")
    kept = (F.col("node") == F.col("class_node")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return found.select("doc_id", "node").join(placed, "node").select("doc_id", "node", "root", "class_id", kept.alias("kept"))


def one_of_each(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of `documents` that stand for their class: one row of each, whole and with all columns."""
    found = near_duplicates(documents, least).where("kept").select(F.col("doc_id").alias("keep_id"), F.col("node").alias("keep_node")).distinct()
    rows = documents.select(F.struct(*documents.columns).alias("d"), F.col("doc_id").alias("keep_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("keep_node"))
    rows = rows.join(found, rows["keep_id"].eqNullSafe(found["keep_id"]) & (rows["keep_node"] == found["keep_node"]), "left_semi")
    same = Window.partitionBy("keep_node", "keep_id").orderBy(F.lit(1))  # repeated rows differ in no column that counts
    return rows.withColumn("n", F.row_number().over(same)).where("n = 1").select("d.*")
