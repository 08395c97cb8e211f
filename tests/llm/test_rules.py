from __future__ import annotations

from collections import Counter

import pytest

from duelframe.llm import rules
from duelframe.llm.common import ship
from duelframe.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, duck
from tests.llm.rows import CLASHES, LONG, PROSE, ROWS, edges, nothing


def plain(text: str) -> tuple[int, ...]:
    """The base counts, word by word."""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dups += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered), sum("A" <= c <= "Z" for c in text)


@pytest.mark.parametrize("text", ["", " \n ", PROSE, LONG[:5000], "a b c d e", "a b c d e a b c d e", "a b c d e f a b c d e", "x\nx\n\nx\n x", "a\xa0b\x85c d", "A|B <c> 日本 # 日本", "w " * 50])
def test_counts_as_by_hand(text):
    assert rules.count_text(text) == plain(text)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_as_in_duckdb(spark, folder):
    name = "op5_adaptive_rules"
    assert difference(spark, duck(folder), folder, QUERIES[name], ORACLE_SQL[name]) is None


def test_sketches_merge_and_quantiles_are_close(spark):
    values = [(i * i % 977, f"s{i % 7}") for i in range(5000)]
    rows = spark.createDataFrame(values, "v long, source string").select("source", rules.F.lit("symbols").alias("ratio"), rules.bucket(rules.F.col("v")).alias("edge"))
    parts = rows.groupBy("source", "ratio", "edge").agg(rules.F.count("*").alias("n"))
    found = rules.limits(rules.merge(parts).withColumn("all", rules.F.lit(1)), "all").first()
    ordered = sorted(v for v, _ in values)
    q25, q75 = ordered[len(ordered) // 4], ordered[3 * len(ordered) // 4]
    assert found["total"] == 5000 and abs(found["symbols_high"] - (q75 + 3 * (q75 - q25) + 20)) <= 0.2 * q75


def test_edge_rows(spark):
    ship(spark)
    rows = rules.judge(edges(spark)).collect()
    assert len(rows) == len(ROWS)
    assert sorted((str(r["doc_id"]), *(r[c] for c in rules.COUNTS)) for r in rows) == sorted((str(r[0]), *plain(r[1] or "")) for r in ROWS)
    assert not any(r["kept"] for r in rows if r["base_failed"]) and {r["doc_id"] for r in rows if r["base_failed"]} >= {1, 2, 3, 7, -9}
    kept = rules.keep(edges(spark))
    assert kept.columns == edges(spark).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows if r["kept"])
    assert all(r[c] == f"clash {c}" for r in kept.collect() for c in CLASHES)


def test_empty_table(spark):
    ship(spark)
    assert rules.judge(nothing(spark)).count() == 0 and rules.keep(nothing(spark)).count() == 0


def test_an_outlier_of_its_group_goes_and_its_like_elsewhere_stays(spark):
    ship(spark)
    words = PROSE.replace(".", "").replace(",", "").split()
    text = lambda i, marks: " ".join(f"{w}{i}{'#' * marks}" for w in words)
    rows = [(i, text(i, 0), "en", "prose") for i in range(300)] + [(1000 + i, text(i, 1), "en", "code") for i in range(300)] + [(5000, text(7, 1), "en", "prose")]
    found = {r["doc_id"]: r["kept"] for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [d for d, kept in found.items() if not kept] == [5000]


def test_limits_fire_on_the_table_and_keep_what_is_labelled_good(spark):
    """On sf0.1 at least four limits reject texts, and under one text in a hundred that is labelled good is lost."""
    ship(spark)
    folder = "/root/testdata/sf0.1"
    counts = rules.stored(rules.text_counts(spark.read.parquet(f"{folder}/documents.parquet")), "counts")
    rows = rules._verdicts(counts, rules.thresholds(counts)).where("not base_failed").toPandas()
    fired = {n: int((rows[f"{n}_ratio"] > rows[f"{n}_high"]).sum()) for n in rules.RATIOS}
    fired["low"] = int((rows["word_length_ratio"] < rows["word_length_low"]).sum())
    assert sum(n > 0 for n in fired.values()) >= 4 and rows["word_length_low"].min() > 100
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(rules.F.max("quality").alias("quality")).toPandas()
    good = rows.merge(labels[labels["quality"] == 1], on="doc_id")
    bad = rows.merge(labels[labels["quality"] == 0], on="doc_id")
    assert len(good) > 3000 and (~good["kept"]).mean() < 0.01 and (~bad["kept"]).mean() > 0.95
