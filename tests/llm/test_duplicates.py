from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np

from duelframe.llm import duplicates
from duelframe.llm.common import ship
from tests.llm.rows import CLASHES, ROWS, edges, nothing


def classes(rows: list[tuple]) -> dict[int, set[int]]:
    """Row numbers by class, comparing every pair of rows."""
    texts = [r[1] or "" for r in rows]
    sets = [duplicates.shingles(t) for t in texts]
    parent = list(range(len(rows)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if texts[i] == texts[j] or (len(sets[i][0]) and len(sets[j][0]) and duplicates.similarity(sets[i], sets[j]) >= duplicates.SIMILARITY):
            parent[find(i)] = find(j)
    found = defaultdict(set)
    for i in range(len(rows)):
        found[find(i)].add(i)
    return found


def check(frame, rows: list[tuple]) -> None:
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"]) for r in duplicates.near_duplicates(frame).collect()))
    expected = []
    for members in classes(rows).values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        expected += [(rows[i][0] is None, rows[i][0] or 0, min(ids) if ids else None) for i in members]
    assert got == sorted(expected)


def variants(rng: random.Random, base: list[str], n: int, changes: int) -> list[str]:
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(changes):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_edge_rows(spark):
    ship(spark)
    check(edges(spark), ROWS)
    one = duplicates.one_of_each(edges(spark))
    assert one.columns == edges(spark).columns and one.count() == len(classes(ROWS))
    assert all(r[c] == f"clash {c}" for r in one.collect() for c in CLASHES)
    assert duplicates.near_duplicates(nothing(spark)).count() == 0 and duplicates.one_of_each(nothing(spark)).count() == 0


def test_chains_borders_and_shared_passages_as_by_brute_force(spark, monkeypatch):
    """Copies at all distances about the threshold, chains of them, and a passage that many texts share."""
    ship(spark)
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for changes in (1, 2, 3, 4, 5, 8):
        texts += variants(rng, words(150), 12, changes)
    chain = words(120)
    for _ in range(15):
        chain = chain[6:] + words(6)
        texts.append(" ".join(chain))
    passage = words(60)
    texts += [" ".join(words(10) + passage + words(10)) for _ in range(40)]
    texts += [" ".join(words(25)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)]
    monkeypatch.setattr(duplicates, "BLOCK", 5)  # blocks meet in groups of their own
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_table_as_by_brute_force(spark):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(2)
    for n in (4, 300, 4000):
        a = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64))
        wa = rng.integers(1, 4, n) * rng.choice([0.5, 1.0], n)
        b, wb = a[: 3 * n // 4], wa[: 3 * n // 4] * rng.choice([0.5, 1.0], 3 * n // 4)
        x, y = duplicates.signature(a, wa, 5000), duplicates.signature(b, wb, 5000)
        assert abs((x == y).mean() - duplicates.similarity((a, wa), (b, wb))) < 0.035


def test_components_of_paths_stars_and_rings(spark):
    ship(spark)
    rng = random.Random(9)
    edges_ = [(i, i + 1) for i in range(0, 70)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    names = list(range(300))
    rng.shuffle(names)
    got = {r["node"]: r["root"] for r in duplicates.components(spark.createDataFrame([(names[a], names[b]) for a, b in edges_], "a long, b long")).collect()}
    for group in (range(71), range(100, 160), range(200, 209)):
        members = {names[i] for i in group}
        assert {got.get(m, m) for m in members} == {min(members)}
