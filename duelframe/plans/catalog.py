"""The registered queries: every operator over the given tables.

Each takes (spark, folder) and stays lazy, apart from the ones that load tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.operators import categories as cat
from duelframe.operators import clean, load, quality, ranking, team
from duelframe.operators import correlation as corr
from duelframe.operators import metrics as met
from duelframe.plans import pipeline, reports
from duelframe.sources import bridge, landing, tables
from duelframe.schemas import CONTEST_KEY, ENTITY_ID, MAX_ENTITY_ID
from duelframe.functions import columns as fn
from duelframe.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# What a user picks from the category list for the reports on one category.
CATEGORY = "ECONOMY"


def query(fun: Query) -> Query:
    QUERIES[fun.__name__] = fun
    return fun


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics with the score rounded: logarithms differ between engines in the last digit."""
    found = met.outcome_metrics(
        bridge.entities(spark, folder), bridge.contests(spark, folder), on_empty="zero"
    )
    return found.withColumn("weighted_score", F.round("weighted_score", 9))


def correlations(spark: SparkSession, folder: str) -> DataFrame:
    found = corr.attribute_correlation(scored(spark, folder))
    return found.withColumn("r", F.round("r", 9))


def stored_entities(spark: SparkSession, folder: str) -> DataFrame:
    """An older state of the entity table: all parts, numbered in twos, with older attributes."""
    return bridge.derive(bridge.table(spark, folder, "part"), bridge.STORED_ENTITIES)


def incoming_entities(spark: SparkSession, folder: str) -> DataFrame:
    """A batch for it: all parts, numbered in threes, some without a second category."""
    return bridge.derive(bridge.table(spark, folder, "part"), bridge.INCOMING_ENTITIES)


def stored_contests(spark: SparkSession, folder: str) -> DataFrame:
    """An older state of the contest table: all lines, decided by another quantity."""
    lines = bridge.table(spark, folder, "lineitem")
    return load.distinct_contests(bridge.derive(lines, bridge.STORED_CONTESTS))


# --- scans and metrics ---


@query
def entity_scan(spark, folder):
    return bridge.entities(spark, folder)


@query
def contest_scan(spark, folder):
    return bridge.contests(spark, folder)


@query
def entity_lookup(spark, folder):
    return load.get_by_id(bridge.entities(spark, folder), 42)


@query
def total_battles(spark, folder):
    return met.total_battles(bridge.contests(spark, folder))


@query
def total_wins(spark, folder):
    return met.total_wins(bridge.contests(spark, folder))


@query
def outcome_counts(spark, folder):
    return met.outcome_counts(bridge.contests(spark, folder))


@query
def outcome_metrics(spark, folder):
    return scored(spark, folder)


@query
def outcome_metrics_raw_contests(spark, folder):
    found = met.outcome_metrics(
        bridge.entities(spark, folder), bridge.raw_contests(spark, folder), on_empty="zero"
    )
    return found.select(
        ENTITY_ID, "total_battles", "total_wins", "win_rate", F.round("weighted_score", 9).alias("weighted_score")
    )


# --- rankings, categories, correlation, team ---


@query
def ranking_by_score(spark, folder):
    return ranking.ranking(scored(spark, folder), top_n=10)


@query
def ranking_full(spark, folder):
    return ranking.ranking(scored(spark, folder)).select(ENTITY_ID, "name", "weighted_score")


@query
def ranking_positions(spark, folder):
    """The place of every entity in the whole ranking."""
    found = ranking.ranking_positions(scored(spark, folder), tables.scratch_folder(spark, "ranking-positions"))
    return found.select(ENTITY_ID, "weighted_score", "position")


@query
def top_win_rate(spark, folder):
    return ranking.top_win_rate(scored(spark, folder), min_battles=30, top_n=20)


@query
def category_win_rate(spark, folder):
    return cat.category_win_rate(scored(spark, folder))


@query
def categories_long(spark, folder):
    return cat.categories_long(scored(spark, folder))


@query
def category_list(spark, folder):
    return cat.category_list(bridge.entities(spark, folder))


@query
def best_by_category(spark, folder):
    return cat.best_by_category(scored(spark, folder))


@query
def top_n_by_category(spark, folder):
    return cat.top_n_by_category(scored(spark, folder), 5)


@query
def top_n_in_category(spark, folder):
    return cat.top_n_by_category(scored(spark, folder), 5, CATEGORY)


@query
def attribute_correlation(spark, folder):
    return correlations(spark, folder)


@query
def correlation_matrix(spark, folder):
    found = corr.correlation_matrix(scored(spark, folder))
    return found.select("stat", *[F.round(c, 9).alias(c) for c in ("win_rate", "weighted_score")])


@query
def attribute_profile(spark, folder):
    found = corr.attribute_profile(scored(spark, folder))
    return found.withColumns({c: F.round(c, 9) for c in ("mean", "scaled")})


@query
def diverse_top_n(spark, folder):
    return team.diverse_top_n(scored(spark, folder), team_size=10)


@query
def diverse_top_n_many_types(spark, folder):
    return team.diverse_top_n(scored(spark, folder), team_size=6, type_1_column="type_2")


@query
def plain_top_n(spark, folder):
    return team.diverse_top_n(scored(spark, folder), diversity_by_type=False)


# --- cleaning ---


@query
def clean_entities(spark, folder):
    return clean.clean_entities(bridge.raw_entities(spark, folder))


@query
def split_types_column(spark, folder):
    parts = bridge.table(spark, folder, "part")
    texts = parts.selectExpr("p_partkey AS entity_id", "concat(' ', p_type, ' , ', p_brand, '| ', p_name) AS types")
    return clean.split_types_column(texts)


@query
def coerce_flags(spark, folder):
    flags = bridge.raw_entities(spark, folder).select("name", "legendary")
    return clean.coerce_flag(flags).groupBy("legendary").agg(F.count(F.lit(1)).alias("n"))


@query
def key_range_filter(spark, folder):
    return clean.within_key_range(bridge.entities(spark, folder), max_id=MAX_ENTITY_ID)


@query
def numeric_coercion(spark, folder):
    raw = clean.resolve_aliases(bridge.raw_entities(spark, folder), clean.ENTITY_ALIASES)
    numbers = {
        "id_long": fn.to_long(F.col("entity_id"), fn.dtype(raw, "entity_id")),
        "attack_double": fn.to_double(F.col("attack"), fn.dtype(raw, "attack")),
        "attack_int": fn.to_int(F.col("attack"), fn.dtype(raw, "attack")),
        "attack_filled": fn.filled(F.col("attack"), fn.dtype(raw, "attack")),
        "defense_int": fn.to_int(F.col("defense"), fn.dtype(raw, "defense")),
    }
    return raw.select("name", *[c.alias(n) for n, c in numbers.items()])


@query
def clean_contests(spark, folder):
    return clean.clean_contests(bridge.raw_contests(spark, folder))


# --- loads ---


@query
def conform_entities(spark, folder):
    cleaned = clean.clean_entities(bridge.raw_entities(spark, folder))
    return load.conform_entities(cleaned)


@query
def entities_upsert(spark, folder):
    return load.upsert_entities(stored_entities(spark, folder), incoming_entities(spark, folder))


@query
def entities_upsert_partial(spark, folder):
    return load.upsert_entities(
        stored_entities(spark, folder), incoming_entities(spark, folder), partial=True
    )


@query
def new_entities(spark, folder):
    return load.new_entities(incoming_entities(spark, folder), stored_entities(spark, folder))


@query
def existing_ids(spark, folder):
    return load.existing_ids(stored_entities(spark, folder), incoming_entities(spark, folder))


@query
def last_per_key(spark, folder):
    lines = bridge.table(spark, folder, "lineitem")
    rows = lines.selectExpr(
        "l_partkey AS entity_id", "l_shipdate AS arrived", "l_orderkey AS seq", "l_quantity AS hp"
    )
    return load.last_per_key(rows, ["arrived", "seq"]).drop("arrived")


@query
def entity_load_report(spark, folder):
    raw = clean.resolve_aliases(bridge.raw_entities(spark, folder), clean.ENTITY_ALIASES)
    return load.entity_load_report(raw, stored_entities(spark, folder))


@query
def delete_by_key(spark, folder):
    return load.delete_by_key(bridge.entities(spark, folder), incoming_entities(spark, folder))


@query
def contests_dedup(spark, folder):
    return load.distinct_contests(bridge.contests(spark, folder))


@query
def contests_fk_filter(spark, folder):
    return load.known_contests(bridge.contests(spark, folder), stored_entities(spark, folder))


@query
def contests_fk_filter_hot(spark, folder):
    """The key check where one id, which is stored, takes part in every third contest, and one that isn't in every seventh."""
    lines = bridge.table(spark, folder, "lineitem")
    return load.known_contests(bridge.derive(lines, bridge.HOT_CONTESTS), stored_entities(spark, folder))


@query
def existing_contests(spark, folder):
    return load.existing_contests(
        stored_contests(spark, folder), load.distinct_contests(bridge.contests(spark, folder))
    )


def classified(spark: SparkSession, folder: str) -> DataFrame:
    keys = load.batch_keys(bridge.raw_contests(spark, folder))
    stored = bridge.derive(bridge.table(spark, folder, "lineitem"), bridge.STORED_CONTESTS)
    return load.classify_contests(keys, bridge.entities(spark, folder), stored)


@query
def contests_append(spark, folder):
    return load.contests_to_insert(classified(spark, folder))


@query
def unknown_ids(spark, folder):
    contests = clean.clean_contests(bridge.raw_contests(spark, folder))
    return load.unknown_ids(contests, stored_entities(spark, folder))


@query
def contests_classified(spark, folder):
    return classified(spark, folder)


@query
def contest_load_report(spark, folder):
    return load.contest_load_report(classified(spark, folder))


# --- landed pages ---


@query
def paged_ingest(spark, folder):
    return landing.raw_entities(landing.records(landing.page_items(bridge.entity_pages(spark, folder))))


@query
def paged_ingest_limited(spark, folder):
    rows = landing.raw_entities(landing.records(landing.page_items(bridge.entity_pages(spark, folder))))
    return landing.first_records(rows, 500).select("page", "pos", ENTITY_ID, "hp")


@query
def paged_contests_half(spark, folder):
    """The first half of all landed contests, which is more than one task should sort out."""
    rows = landing.raw_contests(landing.records(landing.page_items(bridge.contest_pages(spark, folder))))
    half = rows.count() // 2
    return landing.first_records(rows, half, folder=tables.scratch_folder(spark, "paged-contests-half"))


@query
def paged_ingest_repeated_keys(spark, folder):
    """Pages in which one record of three repeats a field, and one repeats a field further inside."""
    items = landing.page_items(bridge.repeated_key_pages(spark, folder))
    return landing.raw_entities(landing.records(items)).select("page", "pos", ENTITY_ID, "name", "hp")


@query
def quarantined_whole_texts(spark, folder):
    """Long pages without records: all of the text, and how a log shows it.

    The texts are far larger than the file they are made from, by whose size the join would broadcast them.
    """
    items = landing.page_items(bridge.long_pages(spark, folder))
    log = landing.quarantine_log(items).select("page", "preview", "n_chars")
    return landing.quarantine(items).select("page", "text").join(log.hint("merge"), "page")


@query
def paged_contests(spark, folder):
    items = landing.page_items(bridge.contest_pages(spark, folder))
    return clean.clean_contests(landing.raw_contests(landing.records(items))).select(*CONTEST_KEY)


@query
def quarantined_records(spark, folder):
    return landing.quarantine(landing.page_items(bridge.entity_pages(spark, folder)))


def details(spark: SparkSession, folder: str) -> DataFrame:
    return landing.raw_entities(landing.records(landing.page_items(bridge.entity_pages(spark, folder))))


@query
def detail_fetch(spark, folder):
    found = landing.details_for(stored_entities(spark, folder), details(spark, folder))
    return found.select("page", "pos", ENTITY_ID, "hp")


@query
def detail_misses(spark, folder):
    return landing.missing_details(bridge.entities(spark, folder), details(spark, folder))


@query
def detail_fallback(spark, folder):
    """Details where there are any, and the listing where no listed id has one."""
    landed = details(spark, folder)
    listing = bridge.entities(spark, folder).select(F.col(ENTITY_ID).cast("string").alias(ENTITY_ID), F.lit("listing").alias("origin"))
    unheard = listing.select(F.concat(F.lit("-1"), ENTITY_ID).alias(ENTITY_ID), "origin")
    found = []
    for ids in (listing, unheard):
        wanted = landing.details_for(ids, landed).select(ENTITY_ID, F.lit("details").alias("origin"))
        wanted = pipeline.staged(wanted, tables.scratch_folder(spark, "detail-fallback"))  # computed once
        found.append(landing.details_or_listing(wanted, ids))
    return found[0].unionByName(found[1])


@query
def table_scan(spark, folder):
    """A stored table by its schema, projected and mapped."""
    schema = T.StructType.fromDDL(bridge.SCHEMAS["part"])
    return tables.read_table(spark, f"{folder}/part.parquet", schema, ["p_partkey", "p_size"], lambda df: df.filter("p_size > 10"))


@query
def flag_default(spark, folder):
    """The flag of a table that lacks the column."""
    return clean.coerce_flag(bridge.entities(spark, folder).select(ENTITY_ID))


# --- quality and reports ---


@query
def quality_report(spark, folder):
    entities, contests = bridge.entities(spark, folder), bridge.contests(spark, folder)
    return quality.quality_report(entities, contests, met.outcome_metrics(entities, contests, on_empty="zero"))


@query
def quality_report_of_empty(spark, folder):
    """The checks by line number: there are none for the contests of a number that no order has lines of."""
    entities, lines = bridge.entities(spark, folder), bridge.table(spark, folder, "lineitem")
    found = None
    for number in (7, 8):
        contests = bridge.derive(lines.filter(F.col("l_linenumber") == number), bridge.CONTESTS)
        report = quality.quality_report(entities, contests, met.outcome_metrics(entities, contests, on_empty="zero"))
        report = report.withColumn("line", F.lit(number))
        found = report if found is None else found.unionByName(report)
    return found


@query
def quality_report_raw(spark, folder):
    entities = clean.clean_entities(bridge.raw_entities(spark, folder))
    contests = clean.clean_contests(bridge.raw_contests(spark, folder))
    doubled = entities.unionByName(entities)
    found = met.outcome_metrics(entities, contests, on_empty="zero")
    return quality.quality_report(doubled, contests, found)


@query
def kpi_summary(spark, folder):
    return reports.kpi_summary(bridge.entities(spark, folder), bridge.contests(spark, folder))


@query
def top_attribute(spark, folder):
    return corr.top_attribute(correlations(spark, folder))


@query
def influence(spark, folder):
    return corr.influence(correlations(spark, folder))


@query
def influence_extremes(spark, folder):
    return corr.influence_extremes(correlations(spark, folder))


@query
def influence_table(spark, folder):
    return corr.influence_table(correlations(spark, folder))


@query
def top_correlations(spark, folder):
    return corr.top_correlations(correlations(spark, folder), 3)


@query
def correlation_bars(spark, folder):
    return reports.correlation_bars(correlations(spark, folder))


@query
def win_rate_by_type(spark, folder):
    return reports.win_rate_by_type(scored(spark, folder))


@query
def top_cards(spark, folder):
    return reports.top_cards(scored(spark, folder), CATEGORY)


@query
def team_cards(spark, folder):
    return reports.team_cards(scored(spark, folder))


@query
def team_cards_ten(spark, folder):
    return reports.team_cards(scored(spark, folder), team_size=10)


@query
def diagnostics(spark, folder):
    return reports.diagnostics(scored(spark, folder), CATEGORY)


@query
def diagnostic_message(spark, folder):
    return reports.diagnostic_message(scored(spark, folder), CATEGORY)


@query
def win_rate_table(spark, folder):
    return reports.win_rate_table(cat.best_by_category(scored(spark, folder)))


# --- whole jobs ---


@query
def load_job(spark, folder):
    """Pages to stored tables, and metrics over them."""
    warehouse = tables.scratch_folder(spark, "load-job")
    pipeline.run_pipeline(
        spark,
        warehouse,
        listing_pages=bridge.entity_pages(spark, folder),
        contest_pages=bridge.contest_pages(spark, folder),
    )
    found = pipeline.store_metrics(spark, warehouse)
    return found.withColumn("weighted_score", F.round("weighted_score", 9))


@query
def stream_load_job(spark, folder):
    """Contest pages landed as files and loaded as a stream, next to stored entities."""
    base = tables.scratch_folder(spark, "stream-load-job")
    tables.publish_entities(bridge.entities(spark, folder), f"{base}/warehouse")
    bridge.contest_pages(spark, folder).write.json(f"{base}/pages")
    pages = incremental.stream_pages(spark, f"{base}/pages")
    incremental.append_stream(pages, f"{base}/warehouse", f"{base}/checkpoint").awaitTermination()
    return tables.read_contests(spark, f"{base}/warehouse")


@query
def load_job_quarantine(spark, folder):
    """What the load job sets aside: bad pages and records of both sources, and entities without a name."""
    warehouse = tables.scratch_folder(spark, "load-job-quarantine")
    pipeline.run_pipeline(
        spark,
        warehouse,
        listing_pages=bridge.entity_pages(spark, folder).unionByName(bridge.nameless_pages(spark, folder)),
        contest_pages=bridge.contest_pages(spark, folder).unionByName(bridge.long_pages(spark, folder)),
    )
    return tables.read_quarantine(spark, warehouse).select("source", "page", "pos", "reason", F.length("text").alias("n_chars"))


@query
def stream_late_entities(spark, folder):
    """Contests landed as a stream before most of their entities are stored, which load them afterwards."""
    base = tables.scratch_folder(spark, "stream-late-entities")
    warehouse = f"{base}/warehouse"
    entities = bridge.entities(spark, folder)
    pipeline.load_entities(spark, entities.filter(F.col(ENTITY_ID) % 2 == 0), warehouse)
    bridge.contest_pages(spark, folder).write.json(f"{base}/pages")
    pages = incremental.stream_pages(spark, f"{base}/pages")
    incremental.append_stream(pages, warehouse, f"{base}/checkpoint").awaitTermination()
    pipeline.load_entities(spark, entities.filter(F.col(ENTITY_ID) % 2 == 1), warehouse)
    tables.compact_contests(spark, warehouse)
    return tables.read_contests(spark, warehouse)


# --- stored tables from load to load ---


def loaded(spark: SparkSession, folder: str, name: str) -> str:
    """A new warehouse with all entities and all contests."""
    warehouse = tables.scratch_folder(spark, name)
    tables.publish_entities(bridge.entities(spark, folder), warehouse)
    pipeline.load_contests(spark, bridge.contests(spark, folder), warehouse)
    return warehouse


@query
def contests_batch_load(spark, folder):
    """A batch of about a thousand contests, those of the first ids decided otherwise, loaded next to all contests."""
    warehouse = loaded(spark, folder, "contests-batch-load")
    lines = bridge.table(spark, folder, "lineitem").filter("l_partkey <= 33")
    pipeline.load_contests(spark, bridge.derive(lines, bridge.STORED_CONTESTS), warehouse)
    return tables.read_contests(spark, warehouse)


@query
def entities_load_ranges(spark, folder):
    """Two loads of entities into a table of many ranges, some of which the second load doesn't touch or cuts."""
    warehouse = tables.scratch_folder(spark, "entities-load-ranges")
    tables.publish_entities(stored_entities(spark, folder), warehouse, range_rows=300)
    pipeline.load_entities(spark, incoming_entities(spark, folder), warehouse, range_rows=300)
    return tables.read_entities(spark, warehouse)


@query
def metrics_after_loads(spark, folder):
    """Metrics from the counts that two loads of contests have kept."""
    warehouse = loaded(spark, folder, "metrics-after-loads")
    lines = bridge.table(spark, folder, "lineitem")
    pipeline.load_contests(spark, bridge.derive(lines, bridge.STORED_CONTESTS), warehouse)
    found = pipeline.stored_metrics(spark, warehouse)
    return found.withColumn("weighted_score", F.round("weighted_score", 9))


@query
def contests_deleted(spark, folder):
    """The contests after a deletion, and again after the table has been compacted, with their metrics' totals."""
    warehouse = loaded(spark, folder, "contests-deleted")
    pipeline.delete_contests(spark, warehouse, stored_contests(spark, folder))
    totals = tables.read_counts(spark, warehouse).agg(F.sum("total_battles").alias("battles"), F.sum("total_wins").alias("wins"))
    before = tables.read_contests(spark, warehouse).withColumn("step", F.lit("deleted"))
    tables.compact_contests(spark, warehouse)
    after = tables.read_contests(spark, warehouse).withColumn("step", F.lit("compacted"))
    sums = pipeline.settled(totals).select(F.col("battles").alias("first_id"), F.col("wins").alias("second_id"), F.lit(0).cast("bigint").alias("winner_id"), F.lit("totals").alias("step"))
    return before.unionByName(after).unionByName(sums)


@query
def entities_deleted(spark, folder):
    """The entities after those without a contest have been deleted, by the counts kept beside the contests."""
    warehouse = tables.scratch_folder(spark, "entities-deleted")
    tables.publish_entities(stored_entities(spark, folder), warehouse, range_rows=300)
    pipeline.load_contests(spark, bridge.contests(spark, folder), warehouse)
    named = tables.read_counts(spark, warehouse)
    idle = tables.read_entities(spark, warehouse).join(named, ENTITY_ID, "left_anti")
    pipeline.delete_entities(spark, warehouse, idle)
    return tables.read_entities(spark, warehouse)
