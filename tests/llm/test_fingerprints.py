from __future__ import annotations

import hashlib

import numpy as np
import pytest

from duelframe.llm import fingerprints as fp
from duelframe.llm.common import ship
from tests.llm.rows import PROSE, ROWS, edges, nothing


def expected(rows: list[tuple]) -> list[tuple]:
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, row in enumerate(ordered):
        text, following = row[1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        changed = fp.edited(text, following)
        a, b, c = (fp.fingerprints([x])[0] for x in (text, changed, following))
        out.append((row[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


def test_edge_rows_as_by_brute_force(spark):
    ship(spark)
    for size in (2, 1000):
        assert sorted(map(tuple, fp.fingerprint(edges(spark), size).collect()), key=str) == expected(ROWS)


def test_table_as_by_brute_force(spark):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = fp.fingerprint(docs, 17).collect()
    assert sorted(map(tuple, found), key=str) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert np.mean([r["near_edited"] for r in found]) > 0.2 > np.mean([r["near_next"] for r in found])


def test_one_row_and_none(spark):
    ship(spark)
    one = spark.createDataFrame([(3, PROSE)], "doc_id long, text string")
    assert sorted(map(tuple, fp.fingerprint(one).collect())) == expected([(3, PROSE)])
    assert fp.fingerprint(nothing(spark)).count() == 0


def test_signatures_do_not_depend_on_the_offset():
    rng = np.random.default_rng(8)
    text = " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(2000))
    whole, shifted, half = fp.signatures([text, "zq. " + text + " Something else.", text[len(text) // 2 :]])
    assert len(np.intersect1d(whole, shifted)) > 0.98 * len(whole)
    assert len(np.intersect1d(whole, half)) > 0.97 * len(half)


def test_runs_and_short_texts():
    a, b, c = fp.fingerprints(["a" * 5000, "a" * 5001, "a"])
    assert a and b and c and len({a, b, c}) == 3
    assert fp.likeness("", "") == 1.0 and fp.likeness("", a) == 0.0 and fp.likeness(a, a) == 1.0


def test_phrases_have_two_names_at_least_and_few():
    rng = np.random.default_rng(1)
    names = rng.integers(0, 1 << 62, 10_000).astype(np.uint64)
    found, _ = fp.phrases(names, np.array([0]))
    assert 10_000 / 12 < len(found) < 10_000 / 2


def test_ids_are_whole_numbers(spark):
    for kind in ("string", "double", "decimal(20,0)"):
        docs = spark.createDataFrame([(None, "x")], f"doc_id {kind}, text string")
        with pytest.raises(TypeError, match="not a whole number"):
            fp.fingerprint(docs)
    ship(spark)
    docs = spark.createDataFrame([(3, PROSE), (1, "x")], "doc_id int, text string")
    assert sorted(map(tuple, fp.fingerprint(docs).collect())) == expected([(3, PROSE), (1, "x")])
