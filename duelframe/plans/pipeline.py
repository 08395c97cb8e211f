"""The load job: landed pages to stored tables, and the read side of it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import count
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from duelframe.errors import ConcurrentLoadError, ValidationError
from duelframe.operators import load
from duelframe.operators.checks import require_rows
from duelframe.operators.clean import clean_entities, resolve_aliases
from duelframe.operators.metrics import with_counts
from duelframe.schemas import CONTEST_KEY, ENTITY_ALIASES, ENTITY_ID
from duelframe.sources import landing, tables

T = TypeVar("T")
NO_NAME = "entity without a name"


@dataclass(frozen=True)
class LoadResult:
    entities: DataFrame
    contests: DataFrame
    entity_report: DataFrame
    contest_report: DataFrame
    #: What this run set aside, counted: (source, reason, n).
    quarantine_report: DataFrame


def new_batch(warehouse: str) -> str:
    return f"{warehouse}/batches/{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back.

    What several steps need is computed once, survives the loss of executors, and has
    a size Catalyst knows when it plans the joins of the next step.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, path: str, counts: Sequence[Column]) -> tuple[DataFrame, dict[str, int]]:
    """Like ``staged``, with aggregates that are taken from the rows while they are written."""
    watch = Observation()
    written = staged(df.observe(watch, *counts), path)
    return written, watch.get


def one_row(spark: SparkSession, values: dict[str, int], names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def settled(report: DataFrame) -> DataFrame:
    """A report of a few rows by value, so that it outlives the batch it was read from."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def usable(pages: DataFrame, decode: Callable[..., DataFrame], folder: str, warehouse: str, source: str, batch: str) -> DataFrame:
    """The usable records of landed pages, decoded (raw_entities, raw_contests); the rest is kept in the quarantine table.

    Pages are parsed once: all records are written to ``folder``, a new one, decoded or with the reason why not.
    """
    items = staged(decode(landing.page_items(pages), ["reason", "text"]), folder)
    tables.set_aside(landing.quarantine(items), warehouse, source, batch)
    return items.filter(F.col("reason").isNull()).drop("reason", "text")


def spread(pages: DataFrame) -> DataFrame:
    """Pages of one small file, whose records take long to decode, dealt to all tasks."""
    return pages.repartition(F.xxhash64(*pages.columns))


def entity_source(
    listing_pages: DataFrame, detail_pages: DataFrame | None, warehouse: str, batch: str, max_entities: int | None = None
) -> DataFrame:
    """Raw entity rows, staged: details for the listed ids, or the listing if there are none."""
    name = batch.rsplit("/", 1)[1]
    listing = usable(spread(listing_pages), landing.raw_entities, f"{batch}/listing-items", warehouse, "listing", name)
    if max_entities is not None:
        listing = staged(landing.first_records(listing, max_entities, folder=f"{batch}/listed"), f"{batch}/listing")
    if detail_pages is None:
        return listing
    details = usable(spread(detail_pages), landing.raw_entities, f"{batch}/details-items", warehouse, "details", name)
    return landing.details_or_listing(staged(landing.details_for(listing, details), f"{batch}/details"), listing)


def load_entities(
    spark: SparkSession,
    raw: DataFrame,
    warehouse: str,
    *,
    max_id: int | None = None,
    batch_name: str | None = None,
    range_rows: int = tables.RANGE_ROWS,
) -> DataFrame:
    """Clean, conform and upsert entities; returns the load report.

    Only the ranges of ids that the batch falls into are read and written anew; ``range_rows`` is about how many rows
    a new range gets. Rows without a name are set aside.
    Contests that waited for one of the batch's entities are loaded.
    """
    batch = new_batch(warehouse)
    name = batch_name or batch.rsplit("/", 1)[1]
    rows = resolve_aliases(raw, ENTITY_ALIASES)
    watch = Observation()
    cleaned = clean_entities(rows, max_id=max_id)
    place = [F.col(c).cast(t) if c in cleaned.columns else F.lit(None).cast(t) for c, t in (("page", "bigint"), ("pos", "int"))]
    unnamed = load.unnamed_entities(cleaned, max_id=max_id)
    unnamed = unnamed.select(place[0].alias("page"), place[1].alias("pos"), F.lit(NO_NAME).alias("reason"), F.to_json(F.struct("*")).alias("text"))
    tables.set_aside(unnamed, warehouse, "entities", name)
    ordinal = [c for c in ("page", "pos") if c in cleaned.columns]
    watched = clean_entities(rows.observe(watch, *load.raw_entity_counts(rows, max_id=max_id)), max_id=max_id)
    conformed = load.conform_entities(watched, max_id=max_id, keep=ordinal)
    incoming, found = counted(load.last_per_key(conformed, ordinal).drop(*ordinal), f"{batch}/incoming", [F.count(F.lit(1)).alias("keys")])
    found |= watch.get

    def upsert() -> int:
        """Rows that the touched ranges have more than before."""
        at = tables.entity_ranges(spark, warehouse)
        touched = tables.ranges_with(incoming, at)
        if not touched:
            return 0
        stored = tables.read_entities(spark, warehouse, sorted(touched), at)
        now = tables.replace_ranges(spark, warehouse, at, touched, load.upsert_entities(stored, incoming), range_rows)
        return sum(e["rows"] for e in now.entries) - sum(e["rows"] for e in at.entries)

    found["inserted"] = again_if_overtaken(upsert)
    found["updated"] = found["keys"] - found["inserted"]
    found["source_duplicates"] = found["raw"] - found["out_of_range"] - found["unnamed"] - found["keys"]
    if found["keys"]:
        release_waiting(spark, warehouse, incoming.select(ENTITY_ID), max_id=max_id)
    tables.remove(spark, batch)
    return one_row(spark, found, ["raw", "out_of_range", "unnamed", "source_duplicates", "inserted", "updated"])


#: Times that a load is tried when others change the table in between.
TRIES = 3


def again_if_overtaken(step: Callable[[], T]) -> T:
    """Run a step that reads a table and commits to it, anew if another writer has committed in between."""
    for left in reversed(range(TRIES)):
        try:
            return step()
        except ConcurrentLoadError:
            if not left:
                raise


def load_contests(spark: SparkSession, raw: DataFrame, warehouse: str, *, max_id: int | None = None) -> DataFrame:
    """Append the contests that are valid and new; returns the load report.

    The batch is written as distinct keys, then with statuses. The appended rows are read from there and the
    report is counted while they are written, so they cannot disagree, and running the same batch
    again adds nothing. Of the stored contests only row groups are read that may hold one of the keys. Contests that
    name an entity not stored yet are filed by the id they wait for.
    """
    batch = new_batch(warehouse)
    keys = staged(load.batch_keys(raw, max_id=max_id), f"{batch}/keys")
    entities_at = tables.entity_ranges(spark, warehouse)
    entities = tables.read_entities(spark, warehouse, at=entities_at)
    tries = count()

    def append() -> tuple[DataFrame, dict[str, int]]:
        at = tables.contest_batches(spark, warehouse)
        condition = tables.lookup(keys) if at.entries else None  # nothing to look up in a new table
        stored = tables.read_contests(spark, warehouse, condition, at)
        found = load.classify_contests(keys, entities, load.existing_contests(stored, keys), missing="missing")
        found, counts = counted(found, f"{batch}/classified-{next(tries)}", load.contest_load_counts())
        if counts["inserted"]:
            tables.change_contests(spark, warehouse, at, load.contests_to_insert(found))
        return found, counts

    classified, counts = again_if_overtaken(append)
    if counts["unknown_entity"]:
        waiting = classified.filter(F.col("status") == "unknown_entity")
        again_if_overtaken(lambda: tables.change_waiting(spark, warehouse, waiting))
        now = tables.entity_ranges(spark, warehouse)
        if now.number != entities_at.number:  # what they wait for may have come while they were looked up
            come = load.existing_ids(tables.read_entities(spark, warehouse, at=now), waiting.select(F.col("missing").alias(ENTITY_ID)))
            release_waiting(spark, warehouse, come, max_id=max_id)
    tables.remove(spark, batch)
    return one_row(spark, counts, list(counts))


def release_waiting(spark: SparkSession, warehouse: str, ids: DataFrame, *, max_id: int | None = None) -> None:
    """Load the contests that wait for one of the ids (entity_id), which are stored by now.

    Those that another id is still missing for are filed under that one.
    """
    at = tables.waiting_batches(spark, warehouse)
    ids = ids.select(F.col(ENTITY_ID).alias("missing"))
    condition = tables.lookup(ids, ["missing"]) if at.entries else None
    if condition is None:
        return
    batch = new_batch(warehouse)
    freed = staged(tables.read_waiting(spark, warehouse, condition, at).join(ids, "missing", "left_semi"), f"{batch}/freed")
    if not freed.isEmpty():
        load_contests(spark, freed.select(*CONTEST_KEY), warehouse, max_id=max_id)  # makes them distinct
        again_if_overtaken(lambda: tables.change_waiting(spark, warehouse, freed.select("missing").distinct(), "delete"))
    tables.remove(spark, batch)


def delete_contests(spark: SparkSession, warehouse: str, keys: DataFrame) -> int:
    """Delete the stored contests with the given keys; returns how many there were.

    The keys are written as a deletion, which readers apply until the table is compacted.
    """
    keys = keys.select(*CONTEST_KEY).distinct()
    condition, tries, batch = tables.lookup(keys), count(), new_batch(warehouse)

    def delete() -> int:
        at = tables.contest_batches(spark, warehouse)
        found = staged(load.existing_contests(tables.read_contests(spark, warehouse, condition, at), keys), f"{batch}/found-{next(tries)}")
        n = found.count()
        if n:
            tables.change_contests(spark, warehouse, at, found, "delete")
        return n

    n = 0 if condition is None else again_if_overtaken(delete)
    tables.remove(spark, batch)
    return n


def delete_entities(spark: SparkSession, warehouse: str, ids: DataFrame) -> int:
    """Delete the stored entities with the given ids (entity_id); returns how many there were.

    Raises if a stored contest names one of them, by the counts kept beside the contests. Only the
    ranges that the ids fall into are written anew.
    """
    batch = new_batch(warehouse)
    ids = staged(ids.select(ENTITY_ID).filter(F.col(ENTITY_ID).isNotNull()).distinct(), f"{batch}/ids")
    named = tables.read_counts(spark, warehouse).filter("total_battles > 0 OR total_wins > 0").join(ids, ENTITY_ID, "left_semi")
    if not named.isEmpty():
        tables.remove(spark, batch)
        raise ValidationError("stored contests name an entity that is to be deleted")

    def delete() -> int:
        at = tables.entity_ranges(spark, warehouse)
        touched = [n for n in tables.ranges_with(ids, at) if n < len(at.entries)]
        stored = tables.read_entities(spark, warehouse, touched, at)
        n = load.existing_ids(stored, ids).count()
        if n:
            tables.replace_ranges(spark, warehouse, at, dict.fromkeys(touched, 0), load.delete_by_key(stored, ids))
        return n

    n = again_if_overtaken(delete)
    tables.remove(spark, batch)
    return n


def run_pipeline(
    spark: SparkSession,
    warehouse: str,
    *,
    listing_pages: DataFrame,
    contest_pages: DataFrame,
    detail_pages: DataFrame | None = None,
    max_id: int | None = None,
    max_entities: int | None = None,
    max_records: int | None = None,
) -> LoadResult:
    """Landed pages to stored entities and contests. Safe to run again on the same pages.

    ``max_entities`` and ``max_records`` take the first listed entities and the first contests only.
    Metrics are not stored: stored_metrics derives them from the two tables.
    """
    batch = new_batch(warehouse)
    name = batch.rsplit("/", 1)[1]
    raw = entity_source(listing_pages, detail_pages, warehouse, batch, max_entities)
    entity_report = load_entities(spark, raw, warehouse, max_id=max_id, batch_name=name)
    contests = usable(contest_pages, landing.raw_contests, f"{batch}/contests-items", warehouse, "contests", name)
    contests = landing.first_records(contests, max_records, folder=f"{batch}/pages")
    contest_report = load_contests(spark, contests, warehouse, max_id=max_id)
    aside = tables.read_quarantine(spark, warehouse).filter(F.col("batch") == name)
    tables.remove(spark, batch)
    return LoadResult(
        tables.read_entities(spark, warehouse),
        tables.read_contests(spark, warehouse),
        entity_report,
        contest_report,
        settled(aside.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))),
    )


def stored_metrics(
    spark: SparkSession, warehouse: str, *, max_id: int | None = None, on_empty: str = "error"
) -> DataFrame:
    """Metrics over the stored tables, from the counts that every load of contests keeps; no contest is read."""
    if on_empty not in ("error", "zero"):
        raise ValidationError("on_empty is 'error' or 'zero'")
    entities = clean_entities(tables.read_entities(spark, warehouse), max_id=max_id)
    counts = tables.read_counts(spark, warehouse)
    if on_empty == "error":
        require_rows(entities, "entities")
        require_rows(counts, "contests")
    return with_counts(entities, counts)


def store_metrics(
    spark: SparkSession, warehouse: str, *, max_id: int | None = None, on_empty: str = "error"
) -> DataFrame:
    """Compute the metrics once and keep them as a table; reports then read a row per entity.

    Run it after a load. All reports of a dashboard start from the frame it returns, so
    the contests are read once and not once per report.
    """
    found = stored_metrics(spark, warehouse, max_id=max_id, on_empty=on_empty)
    path = tables.publish_version(found, f"{warehouse}/metrics")
    return spark.read.schema(found.schema).parquet(path)
