"""Properties that hold for any input, on random and on given data."""

import random

import pytest
from pyspark.sql import functions as F

from duelframe import attribute_correlation, diverse_top_n, outcome_metrics
from duelframe.operators import load
from duelframe.sources import bridge
from tests.conftest import MEDIUM

CONTESTS = "first_id bigint, second_id bigint, winner_id bigint"


def random_contests(rng, ids, n):
    rows = []
    for _ in range(n):
        # A third of all contests have the same first entity.
        first = ids[0] if rng.random() < 1 / 3 else rng.choice(ids)
        second = rng.choice(ids + [None])
        rows.append((first, second, rng.choice([first, second])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_sums(spark, seed):
    rng = random.Random(seed)
    ids = list(range(1, 30))
    rows = random_contests(rng, ids, 500)
    entities = spark.createDataFrame([(i, False) for i in ids], "entity_id bigint, legendary boolean")
    found = outcome_metrics(entities, spark.createDataFrame(rows, CONTESTS)).collect()
    assert sum(r.total_battles for r in found) == sum(x is not None for row in rows for x in row[:2])
    assert sum(r.total_wins for r in found) == sum(row[2] is not None for row in rows)
    assert all(0 <= r.win_rate <= 1 for r in found)


def greedy(rows, size):
    """The plain selection loop: rows are (id, type, score), best score first."""
    ordered = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    team, used = [], set()
    for row in ordered:
        category = (row[1] or "").strip()
        if len(team) < size and not (category and category in used):
            team.append(row)
            used.add(category)
    for row in ordered:
        if len(team) < size and row not in team:
            team.append(row)
    return [r[0] for r in team]


@pytest.mark.parametrize("seed", range(8))
def test_team_equals_greedy_loop(spark, seed):
    rng = random.Random(seed)
    types = ["A", "B ", " B", "C", "", None, " "][: rng.randint(2, 7)]
    n = rng.randint(1, 40)
    rows = [(i, rng.choice(types), rng.choice([None, *range(10)])) for i in range(n)]
    rows = [(i, t, None if s is None else float(s)) for i, t, s in rows]
    size = rng.randint(1, 12)
    df = spark.createDataFrame(rows, "entity_id int, type_1 string, weighted_score double").repartition(4)
    assert [r.entity_id for r in diverse_top_n(df, team_size=size).collect()] == greedy(rows, size)


def test_known_figures_of_neighbouring_lines(spark):
    """Contests between neighbouring lines of an order, whose figures are known."""
    lines = bridge.table(spark, MEDIUM, "lineitem")
    lines.createOrReplaceTempView("neighbour_lines")
    pairs = spark.sql(
        """SELECT l_partkey AS first_id, next.l_partkey AS second_id,
             CASE WHEN l_extendedprice >= next.l_extendedprice THEN l_partkey ELSE next.l_partkey END AS winner_id
           FROM (SELECT *, lead(struct(l_partkey, l_extendedprice)) OVER (PARTITION BY l_orderkey
             ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS next FROM neighbour_lines)
           WHERE next IS NOT NULL"""
    )
    assert pairs.count() == 45257
    assert load.distinct_contests(pairs).count() == 45123
    parts = bridge.table(spark, MEDIUM, "part").withColumnsRenamed({"p_partkey": "entity_id"})
    found = outcome_metrics(parts.withColumn("legendary", F.lit(False)), pairs)
    row = found.agg(
        F.sum("total_battles"), F.sum("total_wins"), F.min("total_battles"), F.max("total_battles"), F.avg("win_rate")
    ).collect()[0]
    assert tuple(row)[:4] == (90514, 45257, 19, 80)
    assert row[4] == pytest.approx(0.499769553, abs=1e-9)
    r = attribute_correlation(found, stat_columns=["p_size", "p_retailprice"], metric_columns=["win_rate"])
    values = {x.stat: x.r for x in r.collect()}
    assert values["p_size"] == pytest.approx(0.018594388926, abs=1e-9)
    assert values["p_retailprice"] == pytest.approx(-0.000294953377, abs=1e-9)


def test_results_do_not_depend_on_join_strategy(spark, no_broadcast):
    """Sort-merge plans, a hot key and hot copies give what counting by hand gives."""
    rng = random.Random(7)
    ids = list(range(1, 60))
    rows = random_contests(rng, ids, 800) + [(1, 2, 1)] * 700
    raw = spark.createDataFrame(rows, CONTESTS).repartition(8)
    known = [i for i in ids if i % 4]
    entities = spark.createDataFrame([(i,) for i in known], "entity_id bigint")
    stored_rows = {r for r in rows if None not in r and sum(r) % 3 == 0}
    stored = spark.createDataFrame(sorted(stored_rows), CONTESTS)
    keys = load.batch_keys(raw, max_id=50)
    classified = load.classify_contests(keys, entities, stored)
    report = load.contest_load_report(classified).collect()[0]
    in_range = [r for r in rows if None not in r and max(r) <= 50]
    valid = [r for r in in_range if set(r) <= set(known)]
    assert report.raw == len(rows)
    assert report.out_of_range == len(rows) - len(in_range)
    assert report.unknown_entity == len(in_range) - len(valid)
    assert report.source_duplicates == len(valid) - len(set(valid))
    assert report.already_present == len(set(valid) & stored_rows)
    assert report.inserted == len(set(valid) - stored_rows)
    assert {tuple(r) for r in load.contests_to_insert(classified).collect()} == set(valid) - stored_rows
    assert sorted(tuple(r) for r in load.known_contests(raw.filter("greatest(first_id, second_id, winner_id) <= 50"), entities).collect()) == sorted(valid)
    assert {tuple(r) for r in load.existing_contests(stored, keys).collect()} == {
        r for r in stored_rows if max(r) <= 50
    }
