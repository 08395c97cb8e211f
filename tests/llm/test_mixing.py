from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duelframe.llm import mixing
from duelframe.llm.common import ship
from tests.llm.rows import CLASHES, ROWS, edges, nothing


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(0.01, 50), min_size=1, max_size=30))
def test_schedule_stays_within_one_block(weights):
    period = 512
    slots = mixing.shares(dict(enumerate(weights)), period)
    assert sum(slots.values()) == period and min(slots.values()) >= 1
    sent = mixing.schedule(slots, period)
    assert sorted(t for x in sent.values() for t in x) == list(range(period))
    for s, times in sent.items():
        given_to = 0
        for t in range(period):
            given_to += given_to < len(times) and times[given_to] == t
            assert abs(given_to * period - slots[s] * (t + 1)) < period


def test_every_row_is_sent_and_windows_hold(spark):
    ship(spark)
    mixed = mixing.mix(edges(spark), block=64)
    rows = mixed.collect()
    first = Counter((r["doc_id"], r["text"], r["source"]) for r in rows if r["epoch"] == 0)
    assert first == Counter((r[0], r[1], r[3]) for r in ROWS)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert all(r[c] == f"clash {c}" for r in rows for c in CLASHES if c not in ("slot", "place"))
    by_slot = defaultdict(set)
    for r in rows:
        by_slot[r["slot"]].add((r["source"], r["source_block"], r["epoch"]))
    assert all(len(x) == 1 for x in by_slot.values())


def test_weights_are_met_and_nothing_is_lost(spark):
    ship(spark)
    docs = spark.createDataFrame([(i, "x" * 10, "big" if i % 4 else "small") for i in range(400)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, {"big": 1.0, "small": 1.0}, block=10).collect()
    assert {r["doc_id"] for r in rows} == set(range(400))
    ordered = [r["source"] for r in sorted(rows, key=lambda r: r["slot"])]
    for n in range(1, len(ordered) + 1):
        assert abs(ordered[:n].count("small") - n / 2) < 1
    assert max(r["epoch"] for r in rows if r["source"] == "small") == 2 and all(r["epoch"] == 0 for r in rows if r["source"] == "big")


def test_empty_table_and_bad_weights(spark):
    ship(spark)
    assert mixing.mix(nothing(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.shares({"a": -1.0, "b": 2.0}, 10)
