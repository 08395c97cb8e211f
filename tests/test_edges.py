"""Edge cases on small literal frames."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from duelframe import (
    ValidationError, attribute_correlation, attribute_profile, best_by_category, categories_long,
    category_win_rate, clean_contests, clean_entities, correlation_matrix, diverse_top_n,
    influence_extremes, outcome_metrics, quality_report, ranking, top_attribute, top_n_by_category,
    top_win_rate,
)
from duelframe.functions import columns as fn
from duelframe.operators import clean, correlation, load
from duelframe.operators.grouping import top_rows_per_group
from duelframe.plans import reports
from duelframe.schemas import CONTEST, ENTITY, ENTITY_ALIASES
from duelframe.sources import landing
from duelframe.sources.tables import scratch_folder

CONTESTS = "first_id bigint, second_id bigint, winner_id bigint"

pytestmark = pytest.mark.usefixtures("interpreted")


def contests(spark, *rows):
    return spark.createDataFrame(list(rows), CONTESTS)


def entities(spark, *ids):
    rows = [(i, f"n{i}", "A", None, False) for i in ids]
    return spark.createDataFrame(rows, "entity_id bigint, name string, type_1 string, type_2 string, legendary boolean")


def figures(df, key="entity_id"):
    return {r[key]: (r.total_battles, r.total_wins, r.win_rate) for r in df.collect()}


def column(df, name):
    return [r[name] for r in df.collect()]


# --- metrics ---


def test_self_contest_counts_two_battles(spark):
    found = outcome_metrics(entities(spark, 5), contests(spark, (5, 5, 5)))
    assert figures(found) == {5: (2, 1, 0.5)}


def test_winner_outside_the_pair_still_wins(spark):
    found = outcome_metrics(entities(spark, 1, 2, 9), contests(spark, (1, 2, 9))).collect()
    nine = next(r for r in found if r.entity_id == 9)
    assert (nine.total_battles, nine.total_wins, nine.win_rate, nine.weighted_score) == (0, 1, 1.0, 1.0)


def test_never_fought_gets_zeros(spark):
    found = outcome_metrics(entities(spark, 7), contests(spark, (1, 2, 1))).collect()[0]
    assert (found.total_battles, found.total_wins, found.win_rate, found.weighted_score) == (0, 0, 0.0, 0.0)


def test_missing_participant_is_skipped(spark):
    found = outcome_metrics(entities(spark, 2), contests(spark, (None, 2, 2), (2, None, None)))
    assert figures(found) == {2: (2, 1, 0.5)}


def test_repeated_and_null_entity_rows_are_kept(spark):
    found = outcome_metrics(entities(spark, 3, 3, None), contests(spark, (3, 4, 3)))
    assert sorted((r.entity_id or -1, r.total_battles) for r in found.collect()) == [(-1, 0), (3, 1), (3, 1)]


def test_existing_metric_columns_are_replaced(spark):
    stale = entities(spark, 1).withColumn("total_wins", F.lit(99)).withColumn("win_rate", F.lit(0.1))
    assert figures(outcome_metrics(stale, contests(spark, (1, 2, 1)))) == {1: (1, 1, 1.0)}


def test_aliased_text_contests(spark):
    raw = spark.createDataFrame(
        [("1", "2", "1"), (" 1 ", "x", "1.0"), ("1.5", None, "12345678901234567")],
        "First_pokemon string, pokemon2 string, winner_pokemon string",
    )
    cleaned = clean_contests(raw)
    assert cleaned.columns == ["first_id", "second_id", "winner_id"]
    assert [tuple(r) for r in cleaned.collect()] == [(1, 2, 1), (1, None, 1), (None, None, 12345678901234567)]
    assert figures(outcome_metrics(entities(spark, 1), raw)) == {1: (2, 2, 1.0)}


def test_own_column_names(spark):
    e = entities(spark, 1).withColumnsRenamed({"entity_id": "key", "legendary": "flag"})
    c = contests(spark, (1, 2, 1)).toDF("a", "b", "w")
    found = outcome_metrics(
        e, c, id_column="key", legendary_column="flag", first_column="a", second_column="b", winner_column="w"
    )
    assert figures(found, "key") == {1: (1, 1, 1.0)}


def test_empty_contests(spark):
    none = spark.createDataFrame([], CONTEST)
    with pytest.raises(ValidationError):
        outcome_metrics(entities(spark, 1), none)
    assert figures(outcome_metrics(entities(spark, 1), none, on_empty="zero")) == {1: (0, 0, 0.0)}


def test_missing_columns(spark):
    with pytest.raises(ValidationError):
        outcome_metrics(entities(spark, 1).drop("legendary"), contests(spark, (1, 2, 1)))
    with pytest.raises(ValidationError):
        outcome_metrics(entities(spark, 1), contests(spark, (1, 2, 1)).drop("winner_id"))
    with pytest.raises(ValidationError):
        ranking(entities(spark, 1))


# --- cleaning ---


def test_combined_types(spark):
    raw = spark.createDataFrame(
        [
            (1, "A/B", None), (2, "A/B", "C"), (3, "A|B", None), (4, "/", "C"), (5, " ", " "), (6, None, " D "),
            (7, " A , B / C", None), (8, "A,B|C", None), (9, "A/B", ""),
        ],
        "entity_id int, type_1 string, type_2 string",
    )
    found = {r.entity_id: (r.type_1, r.type_2) for r in clean_entities(raw).collect()}
    assert found == {
        1: ("A", "B"), 2: ("A", "C"), 3: ("A|B", None), 4: (None, "C"), 5: (None, None), 6: (None, "D"),
        7: ("A", "B"), 8: ("A", "B"), 9: ("A", None),
    }


def test_types_column_fills_only_absent_columns(spark):
    raw = spark.createDataFrame([(" A , B / C",), ("|",), ("",), (None,), ("D",)], "types string")
    found = clean.split_types_column(raw)
    assert [(r.type_1, r.type_2) for r in found.collect()] == [
        ("A", "B"), (None, None), (None, None), (None, None), ("D", None),
    ]
    half = clean.split_types_column(raw.withColumn("type_1", F.lit("X")))
    assert column(half, "type_1") == ["X"] * 5 and column(half, "type_2")[0] == "B"
    listed = spark.createDataFrame([(["A", " ", "B"],)], "types array<string>")
    assert [(r.type_1, r.type_2) for r in clean.split_types_column(listed).collect()] == [("A", "B")]


def test_flag_words(spark):
    raw = spark.createDataFrame(
        [(" Yes ",), ("T",), ("1",), ("1.0",), ("no",), (None,), ("\tTRUE\n",)], "legendary string"
    )
    assert column(clean.coerce_flag(raw), "legendary") == [True, True, True, False, False, False, True]
    number = spark.createDataFrame([(1, 1.0), (0, 0.0)], "i int, d double")
    assert column(clean.coerce_flag(number, "i"), "i") == [True, False]
    assert column(clean.coerce_flag(number, "d"), "d") == [False, False]
    assert column(clean.coerce_flag(number), "legendary") == [False, False]


def test_key_range(spark):
    raw = spark.createDataFrame([("799",), ("800",), ("x",), (None,), ("-3",), ("7.0",), ("nan",), ("1d",)], "id string")
    assert column(clean_entities(raw, max_id=799), "entity_id") == [799, -3, 7]
    assert column(clean_entities(raw), "entity_id") == [799, 800, -3, 7]


def test_bad_numbers(spark):
    raw = spark.createDataFrame(
        [("x", "45.5"), ("3.5", "45"), ("3.0", " 7 "), (None, None)], "generation string, hp string"
    )
    found = clean_entities(raw.withColumn("id", F.lit(1)))
    assert column(found, "generation") == [None, None, 3, None]
    assert column(found.select(fn.to_int(F.col("hp"), fn.dtype(found, "hp")).alias("hp")), "hp") == [None, 45, 7, None]
    numbers = spark.createDataFrame([(45.9,), (-45.9,), (math.nan,), (None,)], "v double")
    t = fn.dtype(numbers, "v")
    assert column(numbers.select(fn.to_int(F.col("v"), t).alias("v")), "v") == [45, -45, None, None]
    assert column(numbers.select(fn.to_double(F.col("v"), t).alias("v")), "v") == [45.9, -45.9, None, None]
    assert column(numbers.select(fn.filled(F.col("v"), t, 1.5).alias("v")), "v") == [45.9, -45.9, 1.5, 1.5]


def test_aliases_match_exact_case(spark):
    raw = spark.createDataFrame([(1, 10, 20, 30)], "id int, hp int, atk int, `Sp. Atk` int")
    both = raw.toDF("id", "hp", "HP", "Sp. Atk")
    found = clean.resolve_aliases(both, ENTITY_ALIASES)
    assert found.columns == ["entity_id", "hp", "sp_attack"]
    assert found.select("hp").collect()[0][0] == 10
    found = clean.resolve_aliases(raw.toDF("id", "Attack", "atk", "Sp. Atk"), ENTITY_ALIASES)
    assert found.columns == ["entity_id", "attack", "atk", "sp_attack"]


def test_empty_input_is_an_error_on_request(spark):
    none = spark.createDataFrame([], "id int")
    assert clean_entities(none).count() == 0
    with pytest.raises(ValidationError):
        clean_entities(none, require_input=True)


# --- rankings, categories, correlation, team ---


def scored(spark, *rows):
    return spark.createDataFrame(list(rows), "entity_id bigint, type_1 string, weighted_score double")


def test_missing_scores_rank_last(spark):
    df = scored(spark, (1, "A", math.nan), (2, "A", 0.5), (3, "A", None), (4, "A", 0.5))
    assert column(ranking(df), "entity_id") == [2, 4, 1, 3]
    assert column(ranking(df, top_n=0), "entity_id") == []
    with pytest.raises(ValidationError):
        ranking(df, top_n=-1)


def test_threshold(spark):
    df = spark.createDataFrame([(1, 0.9, 3), (2, 0.8, 10), (3, 0.7, 10)], "entity_id int, win_rate double, total_battles int")
    assert column(top_win_rate(df, min_battles=10), "entity_id") == [2, 3]
    assert column(top_win_rate(df, top_n=1), "entity_id") == [1]


def test_team(spark):
    df = scored(spark, (1, "A", 9.0), (2, "A", 8.0), (3, " A ", 7.0), (4, "B", 6.0), (5, "", 5.0), (6, None, 4.0), (7, "C", 3.0))
    assert column(diverse_top_n(df, team_size=5), "entity_id") == [1, 4, 5, 6, 7]
    assert column(diverse_top_n(df, team_size=7), "entity_id") == [1, 4, 5, 6, 7, 2, 3]
    assert column(diverse_top_n(df, team_size=3, diversity_by_type=False), "entity_id") == [1, 2, 3]
    assert column(diverse_top_n(df.drop("type_1"), team_size=2), "entity_id") == [1, 2]
    with pytest.raises(ValidationError):
        diverse_top_n(df, team_size=0)


def test_team_keeps_identical_rows(spark):
    df = scored(spark, (1, "A", 9.0), (1, "A", 9.0), (2, "B", 1.0))
    assert column(diverse_top_n(df, team_size=3), "entity_id") == [1, 2, 1]


METRICS = "entity_id int, name string, type_1 string, type_2 string, win_rate double, total_battles int, total_wins int"


def test_categories(spark):
    df = spark.createDataFrame(
        [
            (1, "a", "X", "X", 0.5, 10, 5), (2, "b", " X ", "", 0.5, 20, 10), (3, "c", "Y", None, 0.0, 0, 0),
            (4, "d", None, "Y", 1.0, 4, 4), (5, "e", "Z", None, 0.0, 0, 0),
        ],
        METRICS,
    )
    long = categories_long(df)
    assert sorted((r.entity_id, r.type_source, r.type) for r in long.collect()) == [
        (1, "type_1", "X"), (1, "type_2", "X"), (2, "type_1", "X"), (3, "type_1", "Y"), (4, "type_2", "Y"), (5, "type_1", "Z"),
    ]
    rates = [(r.type, r.total_battles, r.total_wins, r.mean_win_rate, r.sample_size) for r in category_win_rate(df).collect()]
    assert rates == [("Y", 4, 4, 1.0, 4), ("X", 40, 20, 0.5, 40)]
    assert [(r.type, r.name) for r in best_by_category(df).collect()] == [("Y", "d"), ("X", "b")]
    assert [(r.entity_id, r.position) for r in top_n_by_category(df, 5, "X").collect()] == [(2, 1), (1, 2), (1, 3)]
    with pytest.raises(ValidationError):
        category_win_rate(df.filter("total_battles = 0"), on_empty="error")


def test_correlation_edges(spark):
    df = spark.createDataFrame(
        [(5, 1, 1.0, 0.1), (5, 2, 2.0, 0.2), (5, None, 3.0, 0.9), (5, 4, math.nan, 0.4)],
        "hp int, attack int, win_rate double, weighted_score double",
    )
    found = attribute_correlation(df, stat_columns=["hp", "attack"])
    rows = {(r.stat, r.metric): (r.r, r.n) for r in found.collect()}
    assert rows[("hp", "win_rate")] == (None, 3)
    assert rows[("attack", "win_rate")] == (pytest.approx(1.0), 2)
    assert rows[("attack", "weighted_score")][1] == 3
    own = correlation_matrix(df, stat_columns=["win_rate"], metric_columns=["win_rate"]).collect()
    assert own[0].win_rate == pytest.approx(1.0)
    wide = df.select(*[F.lit(float(i)).alias(f"c{i}") for i in range(80)])
    start = time.perf_counter()
    many = attribute_correlation(wide, stat_columns=[f"c{i}" for i in range(60)], metric_columns=[f"c{i}" for i in range(60, 80)])
    many._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 15  # expressions grow with 60 + 20, not with 60 x 20
    assert len(many._jdf.queryExecution().optimizedPlan().toString()) < 60_000 and many.count() == 1200
    empty = attribute_correlation(df.filter("false"), stat_columns=["hp"])
    assert [(r.r, r.n) for r in empty.collect()] == [(None, 0), (None, 0)]
    one = attribute_correlation(df.limit(1), stat_columns=["attack"], metric_columns=["win_rate"])
    assert [(r.r, r.n) for r in one.collect()] == [(None, 1)]


def correlations(spark, **r):
    return spark.createDataFrame([(k, "win_rate", v) for k, v in r.items()], "stat string, metric string, r double")


def test_top_attribute_and_extremes(spark):
    some = correlations(spark, hp=0.1, speed=-0.9, attack=None)
    assert [tuple(x) for x in top_attribute(some).collect()] == [("Velocidade", -0.9)]
    roles = {x.role: (x.label, x.r_text) for x in influence_extremes(some).collect()}
    assert roles == {"most": ("Velocidade", "-0.90"), "second": ("HP", "0.10"), "least": ("HP", "0.10")}
    single = {x.role: x.stat for x in influence_extremes(correlations(spark, hp=0.1)).collect()}
    assert single == {"most": "hp", "second": "hp", "least": "hp"}
    none = correlations(spark, hp=None)
    assert [tuple(x) for x in top_attribute(none).collect()] == [(None, None)]
    assert [tuple(x) for x in top_attribute(none, default_label="Velocidade", default_r=0.91).collect()] == [("Velocidade", 0.91)]


def test_profile(spark):
    df = spark.createDataFrame([(10, 40), (30, 40)], "attack int, defense int")
    found = {r.stat: (r.mean, r.scaled) for r in attribute_profile(df).collect()}
    assert found == {"attack": (20.0, 50.0), "defense": (40.0, 100.0), "hp": (0.0, 0.0), "speed": (0.0, 0.0), "sp_attack": (0.0, 0.0)}
    none = spark.createDataFrame([(1,)], "x int")
    assert {r.scaled for r in attribute_profile(none).collect()} == {0.0}


def test_rows_per_group_beyond_the_threshold(spark):
    df = spark.range(0, 5000, 1, 8).select((F.col("id") % 3 == 0).alias("g"), "id").withColumn("g", F.when(F.col("g"), 1))
    order = [F.col("id").desc()]
    plain = top_rows_per_group(df, ["g"], order, 900).collect()
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        shared = top_rows_per_group(df, ["g"], order, 900).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert len(plain) == 1800
    text = top_rows_per_group(df, ["g"], order, 2000)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("row_number()") == 3  # two levels and the last
    assert sorted(map(repr, plain)) == sorted(map(repr, shared))


# --- number texts ---


@pytest.mark.parametrize("compiled", [False, True])
def test_fixed_format_rounds_like_printf(spark, compiled):
    spark.conf.set("spark.sql.codegen.wholeStage", str(compiled).lower())
    values = [1e17, 1e20, -1e15, 3.125, 1.115, 1.005, 0.285, 28.125, 99.995, 100.0, 0.0, -0.001, -3.125, 2.675, 1e6 / 7, 12.345, 0.5, 2.5, None]
    values += [w / b * 100 for b in range(1, 65) for w in range(b)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for digits in (1, 2, 3):
        found = {r.i: r.t for r in df.select("i", fn.format_fixed(F.col("v"), digits, "%").alias("t")).collect()}
        for i, v in enumerate(values):
            assert found[i] == (None if v is None else f"{v:.{digits}f}%")
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,)], "v double")
    assert column(odd.select(fn.format_fixed(F.col("v"), 2).alias("t")), "t") == [None, "∞", "-∞"]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (1.015,), (-0.125,)], "v double")
    assert column(df.select(fn.round_to(F.col("v"), 2).alias("v")), "v") == [0.12, 0.14, 1.01, -0.12]


def test_clip_and_texts(spark):
    df = spark.createDataFrame([(None, "x" * 501), (2.0, "x" * 500)], "v double, t string")
    assert column(df.select(fn.clip(F.col("v"), 0.0, 1.0).alias("v")), "v") == [None, 1.0]
    assert column(df.select(fn.truncate(F.col("t")).alias("t")), "t") == ["x" * 500 + "...", "x" * 500]


def test_diagnostic_message(spark):
    df = spark.createDataFrame([(1, "Ann", "X", None, 0.0, 32, 1)], METRICS)
    assert column(reports.diagnostic_message(df, "X"), "message") == ["Top do tipo = Ann com 1.0/32.0 = 3.12%"]


# --- quality ---


def test_quality(spark):
    e = entities(spark, 1, 1, None, None)
    c = contests(spark, (1, 2, 1), (1, 2, 9), (1, 2, None))
    m = outcome_metrics(e, c)
    found = {r.check: (r.result, r.status) for r in quality_report(e, c, m).collect()}
    assert found == {
        "pokemon_id nulo": (2, "FALHA"), "pokemon_id duplicado": (2, "FALHA"), "winner nulo": (1, "FALHA"),
        "winner fora do par": (2, "FALHA"), "soma total_battles": (6, "OK"), "soma total_wins": (2, "FALHA"),
    }
    assert quality_report(e, c.filter("false"), m).count() == 0
    absent = quality_report(e.drop("entity_id"), c.drop("winner_id"), m).collect()
    assert [r.status for r in absent[:4]] == ["OK"] * 4


# --- loads ---


def stored(spark, *rows):
    blank = [None] * 6
    return spark.createDataFrame([(i, n, t, None, 1, False, *blank[:-1], s) for i, n, t, s in rows], ENTITY)


def test_upsert_replaces_whole_rows(spark):
    old = stored(spark, (1, "a", "X", 10), (2, "b", "Y", 20))
    new = stored(spark, (2, "bb", None, None), (3, "c", "Z", 30))
    full = {r.entity_id: (r.name, r.type_1, r.speed) for r in load.upsert_entities(old, new).collect()}
    assert full == {1: ("a", "X", 10), 2: ("bb", None, None), 3: ("c", "Z", 30)}
    partial = {r.entity_id: (r.name, r.type_1, r.speed) for r in load.upsert_entities(old, new, partial=True).collect()}
    assert partial == {1: ("a", "X", 10), 2: ("bb", "Y", 20), 3: ("c", "Z", 30)}


def test_last_row_per_key_wins(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "d")], "entity_id int, pos int, name string")
    found = load.last_per_key(df, ["pos"])
    assert sorted(column(found, "name")) == ["c", "d"]


def test_conform_needs_its_columns(spark):
    with pytest.raises(ValidationError):
        load.conform_entities(spark.createDataFrame([(1,)], "entity_id int"))
    own = spark.createDataFrame([(1, "a", "yes")], "key int, label string, flag string")
    found = load.conform_entities(own, columns={"entity_id": "key", "name": "label", "legendary": "flag"}).collect()
    assert (found[0].entity_id, found[0].name, found[0].legendary, found[0].hp) == (1, "a", True, None)


def test_contest_status(spark):
    raw = contests(spark, (1, 2, 1), (1, 2, 1), (1, 3, 1), (1, 2, 2), (None, 2, 2), (1, 900, 1), (1, 900, 900))
    keys = load.batch_keys(raw, max_id=799)
    known = entities(spark, 1, 2)
    assert column(load.unknown_ids(keys, known), "entity_id") == [3]
    found = load.classify_contests(keys, known, contests(spark, (1, 2, 2), (9, 9, 9)))
    by_key = {(r.first_id, r.second_id, r.winner_id): (r.copies, r.status) for r in found.collect()}
    assert by_key == {
        (1, 2, 1): (2, "new"), (1, 3, 1): (1, "unknown_entity"), (1, 2, 2): (1, "present"),
        (None, None, None): (3, "out_of_range"),
    }
    report = load.contest_load_report(found).collect()[0].asDict()
    assert report == {
        "raw": 7, "out_of_range": 3, "unknown_entity": 1, "source_duplicates": 1, "unique_valid": 2,
        "already_present": 1, "inserted": 1,
    }


# --- landed pages ---


def pages(spark, *raws):
    return spark.createDataFrame(list(enumerate(raws, 1)), landing.PAGE_SCHEMA)


def test_envelopes(spark):
    items = landing.page_items(
        pages(
            spark, '[{"id":1},3]', '{"results":"none","items":[{"id":2}]}', "[]", '{"x":1}', "{", '{"combats":[{"id":3},null,[1]]}',
            None, '{"data":[{"id":4}],"results":[]}',
        )
    )
    recs = landing.raw_entities(landing.records(items))
    assert sorted((r.page, r.pos, r.entity_id) for r in recs.collect()) == [(1, 0, "1"), (2, 0, "2"), (6, 0, "3")]
    bad = sorted((r.page, -1 if r.pos is None else r.pos, r.reason) for r in landing.quarantine(items).collect())
    assert bad == [
        (1, 1, landing.NOT_AN_OBJECT), (4, -1, landing.NO_RECORDS), (5, -1, landing.NO_RECORDS),
        (6, 1, landing.NOT_AN_OBJECT), (6, 2, landing.NOT_AN_OBJECT), (7, -1, landing.NO_RECORDS),
    ]


def test_strict_pages_fail(spark):
    items = landing.page_items(pages(spark, '{"x":1}'), strict=True)
    with pytest.raises(Exception, match=landing.NO_RECORDS):
        items.collect()


def test_record_fields(spark):
    raw = """[{"pokemon_id":1,"types":["A","B"],"HP":45.9,"Sp. Atk":"45.5","atk":"7","legendary":1.0,"def":null,"Defense":4},
        {"id":2,"Type 1":"C","types":"D | E","legendary":1,"speed":8e0}]"""
    one, two = sorted(landing.raw_entities(landing.records(landing.page_items(pages(spark, raw)))).collect(), key=lambda r: r.pos)
    assert (one.type_1, one.type_2, one.hp, one.sp_attack, one.attack, one.legendary, one.defense) == (
        "A", "B", 45, None, 7, "1.0", 4,
    )
    assert (two.type_1, two.type_2, two.legendary, two.speed) == ("C", "E", "1", 8)


def test_record_limit(spark):
    items = landing.page_items(pages(spark, '[{"id":1},{"id":2}]', '[{"id":3},{"id":4}]'))
    rows = landing.raw_entities(landing.records(items))
    assert sorted(column(landing.first_records(rows, 3), "entity_id")) == ["1", "2", "3"]
    assert landing.first_records(rows, None).count() == 4 and landing.first_records(rows, 0).count() == 0


def test_repeated_fields_cost_their_own_record(spark):
    items = landing.page_items(
        pages(spark, '[{"id":1},{"id":3,"id":4,"hp":45.9},5,{"id":6,"x":{"a":1,"a":2}}]', '{"results":[{"id":7,"id":8},null]}', '{"x":1,"x":2}')
    )
    recs = landing.raw_entities(landing.records(items)).collect()
    assert sorted((r.page, r.pos, r.entity_id, r.hp) for r in recs) == [(1, 0, "1", None), (1, 1, "4", 45), (2, 0, "8", None)]
    bad = sorted((r.page, -1 if r.pos is None else r.pos, r.reason, r.text) for r in landing.quarantine(items).collect())
    assert bad == [
        (1, 2, landing.NOT_AN_OBJECT, "5"), (1, 3, landing.UNREADABLE, '{"id":6,"x":{"a":1,"a":2}}'),
        (2, 1, landing.NOT_AN_OBJECT, "null"), (3, -1, landing.NO_RECORDS, '{"x":1,"x":2}'),
    ]


def test_quarantine_keeps_whole_texts(spark):
    long = '{"detail":"' + "x" * 2000 + '"}'
    items = landing.page_items(pages(spark, long))
    assert column(landing.quarantine(items), "text") == [long]
    log = landing.quarantine_log(items).collect()[0]
    assert log.preview == long[:500] + "..." and log.n_chars == len(long)


def test_copies_of_known_contests_stay(spark):
    raw = contests(spark, *[(1, 2, 1)] * 10, (2, 1, 2), (1, 3, 1), (None, 1, 1))
    found = sorted(tuple(r) for r in load.known_contests(raw, entities(spark, 1, 2)).collect())
    assert found == [(1, 2, 1)] * 10 + [(2, 1, 2)]


def test_details(spark):
    detail = landing.raw_entities(landing.records(landing.page_items(pages(spark, '[{"id":1,"hp":1},{"id":1,"hp":2}]', '[{"id":5}]'))))
    wanted = spark.createDataFrame([(1,), (1,), (2,)], "entity_id bigint")
    assert [(r.entity_id, r.hp) for r in landing.details_for(wanted, detail).collect()] == [("1", 1)]
    assert column(landing.missing_details(wanted, detail), "entity_id") == [2]


def test_correlation_keeps_its_digits_far_from_zero(spark, monkeypatch):
    rows = [(float(i % 7), float(i * i % 11), i % 3 / 3) for i in range(500)]
    near = spark.createDataFrame(rows, "hp double, attack double, win_rate double").repartition(6)
    far = near.select((F.col("hp") + 1e9).alias("hp"), (F.col("attack") - 1e9).alias("attack"), "win_rate")
    r = lambda df: {(x.stat, x.metric): x.r for x in attribute_correlation(df, metric_columns=["win_rate"], stat_columns=["hp", "attack"]).collect()}
    a, b = r(near), r(far)
    monkeypatch.setattr(correlation, "MOST_PAIRS", 1)  # many pairs go another way
    assert all(abs(x[k] - a[k]) < 1e-6 for x in (r(near), r(far)) for k in a)
    assert all(abs(a[k] - b[k]) < 1e-6 and a[k] is not None for k in a)


def test_first_records_by_their_pages(spark, monkeypatch):
    monkeypatch.setattr(landing, "FEW_RECORDS", 5)
    draw = random.Random(7)
    rows = [(draw.choice([None, *range(40)]), draw.randrange(3), str(draw.randrange(4))) for _ in range(400)]
    frame = spark.createDataFrame(rows, "page long, pos int, first_id string").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for n in (5, 6, 7, 100, 203, 399, 400, 1000):
        found = landing.first_records(frame, n, folder=scratch_folder(spark, "first-records"))
        assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, order[:n])), n
    with pytest.raises(ValidationError):
        landing.first_records(frame, 100)
    assert landing.first_records(frame.limit(0), 100, folder=scratch_folder(spark, "first-records")).count() == 0


def test_key_figures_count_contests_with_missing_ids(spark):
    rows = spark.createDataFrame([(1, 2, 1), (None, 2, 2), (1, None, None), (None, None, 5)], "first_id long, second_id long, winner_id long")
    full = spark.createDataFrame([(i, "n", "A", None, 1, False, i, i, i, i, i, i) for i in (1, 2)], ENTITY)
    row = reports.kpi_summary(full, rows).collect()[0]
    assert (row.total_entities, row.total_contests, row.total_victories) == (2, 4, 3)
    row = reports.kpi_summary(full.limit(0), rows.limit(0), default_label="x", default_r=0.5).collect()[0]
    assert (row.total_entities, row.total_contests, row.total_victories, row.top_attribute, row.top_attribute_r_text) == (0, 0, 0, "x", "0.50")
