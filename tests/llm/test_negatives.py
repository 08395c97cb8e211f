"""Hard negatives against all pairs in plain Python, and what the threshold algorithm reads."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.llm import negatives
from duelframe.llm.common import ship

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    kept = set()
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.add((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[1], r[0] is None, r[0])
    out = []
    for own, label, v in kept:
        if own is None or own % 100:
            continue
        others = [(i, score(v, w), lab) for i, lab, w in kept]
        for positive, most, _ in sorted((r for r in others if r[2] == label and r[0] != own), key=order)[:5]:
            within = [r for r in others if r[2] != label and 80 * most <= 100 * r[1] <= 100 * most]
            out += [(own, positive, n, r[0], most, r[1]) for n, r in enumerate(sorted(within, key=order)[:5], 1)]
    return sorted(out, key=repr)


def found(spark, rows):
    ship(spark)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.withColumns({c: F.lit("clash") for c in ("v", "row", "i", "j", "rank", "windows", "anchor", "score")})
    return sorted((tuple(r) for r in negatives.mine(frame).collect()), key=repr)


def vectors(n, width, labels, seed, spread=0.3):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    out = []
    for i in range(n):
        label = draw.randrange(labels)
        out.append((i, [0.1 * c + draw.gauss(0, spread) for c in centres[label]], label))
    return out


@pytest.mark.parametrize("n, width, labels", [(700, 16, 3), (450, 4, 10), (301, 1, 2)])
def test_negatives_are_those_of_all_pairs(spark, n, width, labels):
    rows = vectors(n, width, labels, n)
    want = plain(rows)
    assert len(want) > 20
    assert found(spark, rows) == want


def test_blocks_meet_in_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 60)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    rows = vectors(900, 8, 4, 9)
    assert found(spark, rows) == plain(rows)


def test_ties_and_copies(spark):
    rows = [(i, [0.5, -0.25, 0.0], i % 3) for i in range(210)] + [(i, [0.25, -0.5, 1.0], i % 2) for i in range(210, 420)]
    want = plain(rows)
    assert want and found(spark, rows) == want


def test_edges(spark):
    rows = vectors(320, 5, 3, 4)
    rows += [
        (400, None, 1), (401, [1.0] * 5, None), (500, [0.1, None, 0.2, 0.0, 0.0], 1), (501, [math.nan] * 5, 1), (502, [math.inf, 0.0, 0.0, 0.0, 0.0], 1),
        (600, [], 1), (601, [2.0, 1.0], 1), (None, [0.5] * 5, 1), (None, [0.4] * 5, 2), (700, [0.0] * 5, 2), (800, [-0.3] * 5, 2), (800, [0.3] * 5, 2), (-100, [0.2] * 5, 0),
        (100, rows[100][1], rows[100][2]), (900, [-1e-9] * 5, 77),
    ]
    want = plain(rows)
    assert {600, 700, -100} & {r[0] for r in want} and found(spark, rows) == want
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0], 1)]) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_large_components_stay_exact_or_are_refused(spark):
    draw = random.Random(8)
    rows = [(i, [float(draw.randrange(-260_000, 260_000)) for _ in range(6)], i % 3) for i in range(300)]
    want = plain(rows)
    assert want and found(spark, rows) == want
    with pytest.raises(Exception, match="a component of 262144 or more"):
        found(spark, [*rows, (1000, [1e9] * 6, 1)])


def test_the_search_stops_at_the_threshold_and_not_before():
    draw = np.random.default_rng(1)
    table = np.floor(256 * draw.normal(size=(20_000, 3)) ** 3).astype(np.float64)
    lists = negatives.Lists(table)
    for anchor in (np.array([3.0, -2.0, 1.0]), np.array([0.0, 0.0, -5.0]), np.array([1.0, 1.0, 1.0])):
        seen, scores = lists.search(anchor, lambda seen, scores, threshold: len(scores) >= 5 and threshold < np.partition(scores, -5)[-5])
        every = table @ anchor
        assert sorted(scores)[-5:] == sorted(every)[-5:]
        assert len(seen) < 5_000  # few rows are scored
    same = negatives.Lists(np.ones((100, 2)))
    seen, _ = same.search(np.array([1.0, 1.0]), lambda seen, scores, threshold: len(scores) >= 5 and threshold < np.partition(scores, -5)[-5])
    assert len(seen) == 100  # a threshold that equals the k-th score does not end the search


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_is_its_sql(spark, folder):
    from duelframe.llm.queries import ORACLE_SQL, QUERIES
    from tests.compare import difference, duck

    folder = f"/root/testdata/{folder}"
    assert difference(spark, duck(folder), folder, QUERIES["op12_hard_negatives"], ORACLE_SQL["op12_hard_negatives"]) is None
