"""Landed API pages: from raw JSON text to records, with what is unusable set aside.

A page is a JSON array of records, or an object holding one under a known key. Pages
arrive as a frame (page bigint, raw string). At scale they should be landed as many
lines per file (read_page_lines), which Spark splits; one file per page also works.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duelframe.errors import ValidationError
from duelframe.functions.columns import dtype, quoted, to_long, truncate
from duelframe.operators.checks import not_negative
from duelframe.operators.clean import category_parts
from duelframe.operators.grouping import top_rows_per_group
from duelframe.schemas import (
    CONTEST_ALIASES, CONTEST_KEY, ENTITY_ALIASES, ENTITY_ID, ENVELOPE_KEYS, STAT_COLUMNS,
)

PAGE_SCHEMA = "page bigint, raw string"
NO_RECORDS = "no record list in page"
NOT_AN_OBJECT = "record is not an object"
UNREADABLE = "record cannot be read"

# A record that repeats a field, read field by field, so that the last value wins.
_REPAIRED = """try_parse_json(to_json(aggregate(map_entries(from_json(t, 'map<string,variant>')),
    CAST(map() AS map<string,variant>), (a, e) -> map_concat(map_filter(a, (k, v) -> k <> e.key), map(e.key, e.value)))))"""
_READ = f"transform(texts, t -> coalesce(try_parse_json(t), CASE WHEN startswith(t, '{{') THEN {_REPAIRED} END))"


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One page per file, numbered by the last digits in the file name."""
    files = spark.read.text(path, wholetext=True)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1)
    return files.select(number.try_cast("bigint").alias("page"), F.col("value").alias("raw"))


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """One page per line: JSON objects {"page": 1, "raw": "..."}; the files can be split."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


def page_items(pages: DataFrame, *, strict: bool = False) -> DataFrame:
    """Every element of every page once: (page, pos, rec, reason, text).

    ``reason`` is NULL for a usable record. Anything else keeps its reason and its
    whole text, and does not stop the other records or pages. With ``strict`` a
    page without a record list fails the job instead.

    A page that repeats a field somewhere cannot be parsed as a whole. Its records are then cut
    out as texts and parsed one by one; in a record that repeats a field the last value
    counts, and one that repeats a field further inside is set aside by itself.
    """
    # A step of its own, so that the text is parsed once and not once per place.
    parsed = pages.select("page", "raw", F.try_parse_json(F.col("raw")).alias("document"))
    places = ["$"] + [f"$.{key}" for key in ENVELOPE_KEYS]
    found = F.coalesce(*[F.try_variant_get("document", place, "array<variant>") for place in places])
    lists = [F.col("raw"), *[F.get_json_object("raw", f"$.{key}") for key in ENVELOPE_KEYS]]
    texts = F.when(F.col("document").isNull(), F.coalesce(*[F.from_json(c, "array<string>") for c in lists]))
    listed = parsed.select("page", "raw", found.alias("found"), texts.alias("texts"))
    found = F.coalesce(F.col("found"), F.expr(_READ))
    if strict:
        found = F.coalesce(found, F.raise_error(F.lit(NO_RECORDS)).cast("array<variant>"))
    listed = listed.select("page", "raw", "texts", found.alias("found"))
    # An element left by an empty list is dropped; one left by a missing list is kept as bad page.
    items = listed.select(
        "page", "raw", "texts", F.col("found").isNull().alias("no_list"), F.posexplode_outer("found").alias("pos", "rec")
    ).filter(F.col("no_list") | F.col("pos").isNotNull())
    is_object = F.schema_of_variant(F.col("rec")).startswith("OBJECT")
    own_text = F.get("texts", F.col("pos"))
    reason = (
        F.when(F.col("no_list"), F.lit(NO_RECORDS))
        .when(F.col("rec").isNull() & own_text.startswith("{"), F.lit(UNREADABLE))
        .when(~F.coalesce(is_object, F.lit(False)), F.lit(NOT_AN_OBJECT))
    )
    bad_text = F.when(F.col("no_list"), F.col("raw")).otherwise(F.coalesce(own_text, F.to_json(F.col("rec")), F.lit("null")))
    return items.withColumn("reason", reason).select(
        "page", "pos", "rec", "reason",
        F.when(F.col("reason").isNotNull(), bad_text).alias("text"),
    )


def records(items: DataFrame) -> DataFrame:
    """The usable records: (page, pos, rec)."""
    return items.filter(F.col("reason").isNull()).select("page", "pos", "rec")


#: Records up to which the first ones are sorted out in one task.
FEW_RECORDS = 10_000


def first_records(rows: DataFrame, max_records: int | None, *, folder: str | None = None) -> DataFrame:
    """The first rows in the order of page, place in it and content; all of them for None.

    It takes decoded rows (raw_entities, raw_contests). Up to FEW_RECORDS each task keeps its own first rows,
    which are narrow, and those meet in one task. Beyond, records are counted by page in the map tasks; the pages with their
    counts are written to ``folder``, a new one on shared storage, in ranges, and running totals say
    which page holds the last record. Pages before it are taken whole by a filter, and its own records alone are sorted.
    """
    if max_records is None:
        return rows
    order = [F.col(c).asc_nulls_first() for c in ["page", "pos", *[c for c in rows.columns if c not in ("page", "pos", "rec")]]]
    if not_negative(max_records, "max_records") <= FEW_RECORDS:
        return rows.orderBy(*order).limit(max_records)
    if folder is None:
        raise ValidationError(f"more than {FEW_RECORDS} records need a folder for the counts of their pages")
    spark = rows.sparkSession
    counts = rows.groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    in_order = F.col("page").asc_nulls_first()
    ranged = counts.repartitionByRange(in_order).sortWithinPartitions(in_order).withColumn("part", F.spark_partition_id())
    ranged.write.parquet(folder)
    ranged = spark.read.schema(ranged.schema).parquet(folder)
    before, last = 0, None
    for row in ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one row per range
        if before + row["n"] >= max_records:
            last = row["part"]
            break
        before += row["n"]
    if last is None:
        return rows
    upto = F.sum("n").over(W.partitionBy("part").orderBy(in_order))
    totals = ranged.filter(F.col("part") == last).select("page", "n", upto.alias("upto"))  # one range of pages
    page, n, reached = totals.filter(F.col("upto") >= max_records - before).orderBy("upto").first()
    rest = max_records - before - (reached - n)
    if page is None:  # records without a page come first
        return rows.filter(F.col("page").isNull()).orderBy(*order).limit(rest)
    earlier = rows.filter(F.col("page").isNull() | (F.col("page") < F.lit(page)))
    return earlier.unionByName(rows.filter(F.col("page") == F.lit(page)).orderBy(*order).limit(rest))


def quarantine(items: DataFrame) -> DataFrame:
    """What was set aside, with the reason and the whole text."""
    return items.filter(F.col("reason").isNotNull()).select("page", "pos", "reason", "text")


def quarantine_log(items: DataFrame) -> DataFrame:
    """What was set aside with its text cut for a log, and how long it is."""
    return quarantine(items).select("page", "pos", "reason", truncate(F.col("text")).alias("preview"), F.length("text").alias("n_chars"))


def _texts(recs: DataFrame, fields: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """The records with one text column per field: that of the first spelling with a value; and the columns to keep.

    A record is decoded once, into a map of texts, however many spellings there are.
    """
    decoded = recs.withColumn("_texts", F.try_variant_get(F.col("rec"), "$", "map<string,string>"))
    found = []
    for name, aliases in fields.items():
        spelled = ", ".join(f"try_element_at(_texts, {quoted(a)})" for a in aliases)
        found.append(F.expr(f"coalesce({spelled}) AS {name}"))
    return decoded.select("page", "pos", "rec", *found, *keep)


def _json_type(aliases: Sequence[str]) -> Column:
    places = [quoted(f"$['{a}']") for a in aliases]
    found = ", ".join(f"try_variant_get(rec, {place}, 'variant')" for place in places)
    return F.expr(f"schema_of_variant(coalesce({found}))")


def _stat(name: str) -> Column:
    """Integer value: a JSON number is truncated, a JSON text must be a plain integer.

    The JSON type is looked up only for values that are not plain integers.
    """
    text = F.col(name)
    is_number = text.isNotNull() & (_json_type(ENTITY_ALIASES[name]) != "STRING")
    return F.coalesce(text.try_cast("int"), F.when(is_number, text.try_cast("double").try_cast("int")))


def _flag(name: str) -> Column:
    """Text of a flag; the number 1.0 keeps its decimals, which make it a false flag."""
    decimal = (F.col(name) == "1") & _json_type([name]).startswith("DECIMAL")
    return F.when(decimal, F.lit("1.0")).otherwise(F.col(name))


def raw_entities(recs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Entity records under the canonical names, with page and pos, and with the columns to keep.

    Attributes are integers, everything else is text for cleaning to coerce. A record
    without own categories takes them from its ``types``, a list or a text.
    """
    names = [ENTITY_ID, "name", "type_1", "type_2", "generation", "legendary", *STAT_COLUMNS]
    texts = _texts(recs, {n: ENTITY_ALIASES.get(n, (n,)) for n in [*names, "types"]}, keep)
    types = F.col("types")
    listed = F.array_join(F.from_json(types, "array<string>"), "/")
    parts = category_parts(F.when(types.startswith("["), listed).otherwise(types))
    derived = {
        "type_1": F.coalesce(F.col("type_1"), F.get("_parts", F.lit(0))),
        "type_2": F.coalesce(F.col("type_2"), F.get("_parts", F.lit(1))),
        "legendary": _flag("legendary"),
        **{c: _stat(c) for c in STAT_COLUMNS},
    }
    rows = texts.withColumn("_parts", parts)
    return rows.select("page", "pos", *[derived.get(n, F.col(n)).alias(n) for n in names], *keep)


def raw_contests(recs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Contest records as texts under the canonical names, with page and pos, and with the columns to keep."""
    return _texts(recs, {c: CONTEST_ALIASES[c] for c in CONTEST_KEY}, keep).drop("rec")


def _keys(df: DataFrame) -> DataFrame:
    """The distinct numeric ids of a frame: (_key)."""
    key = to_long(F.col(ENTITY_ID), dtype(df, ENTITY_ID)).alias("_key")
    return df.select(key).filter(F.col("_key").isNotNull()).distinct()


def details_for(ids: DataFrame, details: DataFrame) -> DataFrame:
    """One detail row per wanted id: the first one landed. Ids without one are left out."""
    keyed = details.withColumn("_key", to_long(F.col(ENTITY_ID), dtype(details, ENTITY_ID)))
    first = top_rows_per_group(keyed, ["_key"], [F.col("page"), F.col("pos")], 1, "_first")
    return first.join(_keys(ids), "_key", "left_semi").select(*details.columns)


def missing_details(ids: DataFrame, details: DataFrame) -> DataFrame:
    """Wanted ids for which no detail was landed: (entity_id)."""
    missing = _keys(ids).join(_keys(details), "_key", "left_anti")
    return missing.withColumnRenamed("_key", ENTITY_ID)


def details_or_listing(details: DataFrame, listing: DataFrame) -> DataFrame:
    """The details, or the listing if there is no detail at all (looks for one row)."""
    return listing if details.isEmpty() else details
