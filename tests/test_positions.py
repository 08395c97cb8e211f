"""Numbers for all rows of an order."""

import random

from pyspark.sql import functions as F

from duelframe.operators.positions import with_positions
from duelframe.sources.tables import scratch_folder


def numbered(spark, rows, schema, order, **more):
    df = spark.createDataFrame(rows, schema).repartition(5)
    return with_positions(df, order, scratch_folder(spark, "positions"), **more)


def test_places_are_those_of_a_sorted_list(spark):
    draw = random.Random(3)
    rows = [(n, draw.choice([None, 1.0, 2.0, draw.random()])) for n in range(3000)]
    found = numbered(spark, rows, "id int, _part double", [F.col("_part").desc_nulls_last(), F.col("id")])
    got = [r["id"] for r in sorted(found.collect(), key=lambda r: r["position"])]
    assert got == [n for n, _ in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))]
    assert sorted(r["position"] for r in found.collect()) == list(range(1, 3001))


def test_groups_count_for_themselves_and_a_null_is_one(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, "a", "a", "a", "b", ""]), n % 700) for n in range(2000)]
    found = numbered(spark, rows, "g string, id int", [F.col("id")], by=["g"], name="nth", total="all").collect()
    for group in {g for g, _ in rows}:
        mine = sorted(id_ for g, id_ in rows if g == group)
        got = sorted((r["nth"], r["id"]) for r in found if r["g"] == group)
        assert got == list(enumerate(mine, 1))
        assert {r["all"] for r in found if r["g"] == group} == {len(mine)}


def test_equal_rows_are_spread_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 8).select(F.lit(7).alias("x"))
        folder = scratch_folder(spark, "positions")
        found = with_positions(df, [F.col("x")], folder)
        assert sorted(r["position"] for r in found.collect()) == list(range(1, 4001))
        ranges = spark.read.parquet(folder).groupBy("_part").count().collect()
        assert max(r["count"] for r in ranges) <= 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_an_empty_frame_has_no_places(spark):
    assert numbered(spark, [], "x int", [F.col("x")]).collect() == []


def test_no_rows_meet_in_one_task(spark):
    df = spark.range(100).withColumnRenamed("id", "entity_id")
    found = with_positions(df, [F.col("entity_id")], scratch_folder(spark, "positions"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "_n" in plan  # the only window adds up the ranges' counts
