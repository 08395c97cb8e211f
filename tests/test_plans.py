"""What the plans must look like to hold at scale."""

import re

import pytest

from duelframe.operators import clean, load
from duelframe.plans.catalog import QUERIES
from duelframe.sources import bridge
from tests.conftest import SMALL

JOBS = {"load_job", "stream_load_job", "load_job_quarantine", "stream_late_entities", "detail_fallback", "contests_batch_load", "entities_load_ranges", "metrics_after_loads", "contests_deleted", "entities_deleted", "paged_contests_half"}
LAZY = sorted(set(QUERIES) - JOBS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, column):
    return len(re.findall(rf"FileScan parquet \[[^\]]*{column}", text))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin|Pandas", text)


def test_metrics_read_contests_once_and_shuffle_them_once(spark, no_broadcast):
    text = plan(QUERIES["outcome_metrics"](spark, SMALL))
    assert scans(text, "l_partkey") == 1
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2  # contest counts, entities
    assert "partial_sum" in text and "SortMergeJoin" in text


@pytest.mark.parametrize("name", ["best_by_category", "top_n_by_category", "last_per_key", "diverse_top_n"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert re.search(r"WindowGroupLimit .* Partial", text) and re.search(r"WindowGroupLimit .* Final", text)


@pytest.mark.parametrize("name", ["ranking_by_score", "top_win_rate", "top_n_in_category", "plain_top_n"])
def test_limits_do_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SMALL))


def test_key_figures_read_each_table_once(spark):
    df = QUERIES["kpi_summary"](spark, SMALL)
    df.collect()
    text = plan(df).split("Initial Plan")[0]
    assert scans(text, "l_partkey") == 1 and scans(text, "p_partkey") == 1


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["category_list"](spark, SMALL))
    assert "ReadSchema: struct<p_brand:string,p_type:string>" in text


def test_key_filters_reach_the_scan(spark):
    assert "LessThanOrEqual(p_partkey,799)" in plan(QUERIES["key_range_filter"](spark, SMALL))
    assert "EqualTo(p_partkey,42)" in plan(QUERIES["entity_lookup"](spark, SMALL))


def test_cleaning_adds_no_shuffle(spark):
    for name in ("clean_entities", "clean_contests", "conform_entities", "paged_ingest", "quarantined_records"):
        assert "Exchange" not in plan(QUERIES[name](spark, SMALL))


def test_costly_keys_are_not_copied_into_filters(spark):
    cleaned = clean.clean_contests(bridge.raw_contests(spark, SMALL))
    text = plan(load.known_contests(cleaned, bridge.entities(spark, SMALL)))
    assert all("try_cast" not in line for line in text.split("\n") if "Filter" in line)


@pytest.mark.parametrize("name", ["attribute_correlation", "correlation_matrix"])
def test_correlation_shuffles_one_row_per_task(spark, name):
    df = QUERIES[name](spark, SMALL)
    df.collect()
    text = plan(df).split("Initial Plan")[0]
    assert re.search(r"HashAggregate\(keys=\[\], functions=\[partial_regr", text)
    # The metrics are joined from two shuffles; after them there is the one exchange of the states, and no rows are multiplied.
    after = text[: text.index("partial_regr")]
    assert after.count("Exchange") == 1 and "Exchange SinglePartition" in after
    assert "Expand" not in after and text.count("Generate") <= 1 + text.count("unpivot")


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_a_classified_batch_takes_four_shuffles(spark, no_broadcast):
    for name in ("contests_classified", "contests_append"):
        text = plan(QUERIES[name](spark, SMALL))
        assert exchanges(text) <= 4 and scans(text, "l_partkey") == 2  # the batch and the stored contests


def test_an_upsert_reads_each_input_once_and_joins_once(spark, no_broadcast):
    for name in ("entities_upsert", "entities_upsert_partial"):
        text = plan(QUERIES[name](spark, SMALL))
        assert scans(text, "p_partkey") == 2 and exchanges(text) == 2 and "Aggregate" not in text


def test_limited_records_are_decoded_before_they_are_ordered(spark):
    text = plan(QUERIES["paged_ingest_limited"](spark, SMALL))
    assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_whole_texts_are_not_broadcast(spark):
    """The texts are made from a small file and much larger than it."""
    text = plan(QUERIES["quarantined_whole_texts"](spark, SMALL))
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


def test_rows_of_a_frequent_id_are_spread_in_every_join(spark, no_broadcast):
    found = re.findall(r"Exchange hashpartitioning\(((?:first|second|winner)_id)#\d+L?, (\w+)", plan(QUERIES["contests_fk_filter_hot"](spark, SMALL)))
    assert set(found) == {("first_id", "_share"), ("second_id", "_share"), ("winner_id", "_share")}
