"""Load logic as frames: conforming, upsert, contest classification, key lookups.

These functions only describe the result; the tables are written in sources/tables.py
and plans/pipeline.py.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions.columns import clean_text, dtype, named, to_bool, to_int, to_long
from duelframe.operators.checks import require_columns
from duelframe.operators.clean import within_key_range
from duelframe.operators.grouping import top_rows_per_group
from duelframe.operators.metrics import keyed_contests
from duelframe.schemas import (
    CONTEST_KEY, ENTITY, ENTITY_ID, FIRST_ID, SECOND_ID, WINNER_ID,
)


def conform_entities(
    df: DataFrame,
    *,
    columns: dict[str, str] | None = None,
    max_id: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows in the stored entity schema; columns the input lacks are NULL.

    ``columns`` names input columns that differ from the stored ones (stored -> input).
    """
    source = {f.name: (columns or {}).get(f.name, f.name) for f in ENTITY.fields}
    require_columns(df, [source[ENTITY_ID], source["name"], source["legendary"]], "entities")
    kept = within_key_range(df, [source[ENTITY_ID]], max_id)
    out = []
    for field in ENTITY.fields:
        name = source[field.name]
        if name not in df.columns:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        c, t = named(name), dtype(df, name)
        if field.name == ENTITY_ID:
            value = to_long(c, t)
        elif field.name == "name":
            value = c.cast("string")
        elif field.name == "legendary":
            value = to_bool(c, t)
        elif field.name in ("type_1", "type_2"):
            value = clean_text(c)
        else:
            value = to_int(c, t)
        out.append(value.alias(field.name))
    conformed = kept.select(*out, *keep)
    return conformed.filter(F.col(ENTITY_ID).isNotNull() & F.col("name").isNotNull())


def unnamed_entities(df: DataFrame, *, max_id: int | None = None) -> DataFrame:
    """Rows of the canonical columns that have a key but no name, which the stored table must have."""
    key = to_long(named(ENTITY_ID), dtype(df, ENTITY_ID))
    return within_key_range(df, [ENTITY_ID], max_id).filter(key.isNotNull() & F.col("name").isNull())


def last_per_key(df: DataFrame, ordinal: Sequence[str] = (), key: str = ENTITY_ID) -> DataFrame:
    """One row per key: the last one by the ordinal columns.

    The remaining columns settle ties, so the choice does not depend on the order in
    which rows happen to arrive.
    """
    rest = [c for c in df.columns if c != key and c not in ordinal]
    order = [F.col(c).desc_nulls_last() for c in [*ordinal, *rest]]
    return top_rows_per_group(df, [key], order, 1, "_last").drop("_last")


def new_entities(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows whose key is not stored yet (the stored table has one row per key)."""
    return incoming.join(stored.select(ENTITY_ID), ENTITY_ID, "left_anti")


def existing_ids(stored: DataFrame, ids: DataFrame) -> DataFrame:
    """The given ids that are stored.

    Listed keys are made distinct before they are joined, here and in the other lookups:
    a key listed very often is then one row, and the shuffle this takes is the join's own.
    """
    return stored.select(ENTITY_ID).join(ids.select(ENTITY_ID).distinct(), ENTITY_ID, "left_semi")


def upsert_entities(stored: DataFrame, incoming: DataFrame, *, partial: bool = False) -> DataFrame:
    """The stored table after inserting and replacing by key.

    Both have one row per key (for ``incoming`` see last_per_key). A replaced row is replaced
    whole, missing values included; ``partial=True`` keeps the stored value where the
    incoming one is NULL. Both inputs are read once and meet in one join by key.
    """
    names = [f.name for f in ENTITY.fields]
    old = stored.select(*[F.col(c).alias(f"_old_{c}") for c in names])
    both = old.join(incoming.select(*names), F.col(f"_old_{ENTITY_ID}") == F.col(ENTITY_ID), "full_outer")
    replaced = F.col(ENTITY_ID).isNotNull()

    def value(c: str) -> Column:
        if partial or c == ENTITY_ID:
            return F.coalesce(F.col(c), F.col(f"_old_{c}"))
        return F.when(replaced, F.col(c)).otherwise(F.col(f"_old_{c}"))

    return both.select(*[value(c).alias(c) for c in names])


def raw_entity_counts(raw: DataFrame, *, max_id: int | None = None) -> list[Column]:
    """raw, out_of_range and unnamed over the raw rows of a load, as aggregates."""
    valid, has_name = _valid(raw, max_id)
    return [F.count(F.lit(1)).alias("raw"), F.count_if(~valid).alias("out_of_range"), F.count_if(valid & ~has_name).alias("unnamed")]


def _valid(raw: DataFrame, max_id: int | None) -> tuple[Column, Column]:
    c = to_long(named(ENTITY_ID), dtype(raw, ENTITY_ID))
    valid = F.coalesce(c.isNotNull() if max_id is None else c <= max_id, F.lit(False))
    return valid, F.col("name").isNotNull() if "name" in raw.columns else F.lit(False)


def entity_load_report(raw: DataFrame, stored: DataFrame, *, max_id: int | None = None) -> DataFrame:
    """One row: raw, out_of_range, unnamed, source_duplicates, inserted, updated.

    Rows are counted per key before the join, so the join sees one row per key.
    """
    c = to_long(named(ENTITY_ID), dtype(raw, ENTITY_ID))
    valid, has_name = _valid(raw, max_id)
    per_key = raw.groupBy(F.when(valid & has_name, c).alias(ENTITY_ID)).agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(~valid).alias("invalid"), F.count_if(valid & ~has_name).alias("unnamed")
    )
    marked = per_key.join(
        stored.select(ENTITY_ID).distinct().withColumn("is_stored", F.lit(True)), ENTITY_ID, "left"
    )
    has_key, is_stored = F.col(ENTITY_ID).isNotNull(), F.col("is_stored").isNotNull()
    copies = F.col("copies")
    return marked.agg(
        _total(copies).alias("raw"),
        _total(F.col("invalid")).alias("out_of_range"),
        _total(F.col("unnamed")).alias("unnamed"),
        _total(F.when(has_key, copies - 1)).alias("source_duplicates"),
        F.count_if(has_key & ~is_stored).alias("inserted"),
        F.count_if(has_key & is_stored).alias("updated"),
    )


#: Ids that are looked for as frequent, counters their sketch keeps, and tasks that the rows of one are dealt to.
FREQUENT, COUNTERS, SHARES = 200, 4_096, 64


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def distinct_contests(contests: DataFrame) -> DataFrame:
    """Each contest once."""
    return contests.select(*CONTEST_KEY).dropDuplicates(CONTEST_KEY)


def _checked(keys: DataFrame, entities: DataFrame) -> DataFrame:
    """Distinct keys, a row for each different id in them: (key, copies, id, unknown).

    All ids are looked up in one join. Keys are distinct by then, and Spark splits the partition of
    an id that very many of them name.
    """
    ids = keys.select(*CONTEST_KEY, "copies", F.explode(F.array_distinct(F.array(*CONTEST_KEY))).alias(ENTITY_ID))
    known = entities.select(ENTITY_ID, F.lit(True).alias("_known"))
    return ids.join(known, ENTITY_ID, "left").select(*CONTEST_KEY, "copies", ENTITY_ID, F.col("_known").isNull().alias("unknown"))


def frequent_ids(contests: DataFrame) -> DataFrame:
    """The ids that take part most often, FREQUENT of them at most: (entity_id).

    They come from a sketch of frequent items: every task keeps COUNTERS counters at most, and the tasks' sketches are
    merged. An id with a share of a few in COUNTERS of all mentions is among the counted ones.
    """
    ids = contests.unpivot([], CONTEST_KEY, "role", ENTITY_ID).filter(F.col(ENTITY_ID).isNotNull())
    top = ids.agg(F.expr(f"approx_top_k({ENTITY_ID}, {FREQUENT}, {COUNTERS})").alias("top"))
    return top.select(F.explode("top").alias("top")).select(F.col("top.item").alias(ENTITY_ID))


def known_contests(contests: DataFrame, entities: DataFrame) -> DataFrame:
    """Contests whose three ids are all stored entities, as often as they occur.

    The ids are made distinct in the map tasks and looked up once; contests that name one of the unknown ones
    are left out. Frequent ids are settled by a small lookup of their own, a table of FREQUENT rows that is broadcast:
    a contest that names an unknown one goes, and one that names a known one is dealt to any of SHARES
    tasks in the joins, as it can't match there. So no task gets all rows of an id.
    """
    keys = contests.select(*CONTEST_KEY).filter(" AND ".join(f"{c} IS NOT NULL" for c in CONTEST_KEY))
    # Always 0, but no literal: Spark would put that into the join condition and partition by the id alone.
    unknown = unknown_ids(keys, entities).withColumn("_share", F.col(ENTITY_ID) % 1)
    stored = entities.select(ENTITY_ID, F.lit(True).alias("_known"))
    frequent = frequent_ids(keys).join(stored, ENTITY_ID, "left").withColumn("_known", F.col("_known").isNotNull())
    rows = keys
    for name in CONTEST_KEY:
        here = frequent.withColumnsRenamed({ENTITY_ID: name, "_known": f"_{name}"})
        rows = rows.join(F.broadcast(here), name, "left").filter(F.coalesce(F.col(f"_{name}"), F.lit(True)))
    for name in CONTEST_KEY:
        share = F.pmod(F.xxhash64(*CONTEST_KEY, F.spark_partition_id()), F.lit(SHARES)) + 1
        rows = rows.withColumn("_share", F.when(F.col(f"_{name}").isNull(), F.lit(0).cast("bigint")).otherwise(share))
        rows = rows.join(unknown.withColumnRenamed(ENTITY_ID, name), [name, "_share"], "left_anti")
    return rows.select(*CONTEST_KEY)


def existing_contests(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """Stored contests that are among the given distinct keys.

    The keys are the side that can be broadcast here, so a small batch is looked up by
    scanning the stored table without shuffling it.
    """
    return stored.select(*CONTEST_KEY).join(keys.select(*CONTEST_KEY), CONTEST_KEY, "left_semi")


def batch_keys(
    contests: DataFrame,
    *,
    max_id: int | None = None,
    first_column: str = FIRST_ID,
    second_column: str = SECOND_ID,
    winner_column: str = WINNER_ID,
) -> DataFrame:
    """The batch as distinct keys with their number of copies.

    Rows with a missing or out-of-range id are collapsed into one all-NULL key. Copies
    are counted in the map tasks first, so a contest that makes up a third of the batch
    is a few rows by the time it is shuffled.
    """
    c = keyed_contests(contests, first_column, second_column, winner_column)
    valid = F.lit(True)
    for name in CONTEST_KEY:
        valid = valid & (F.col(name).isNotNull() if max_id is None else F.coalesce(F.col(name) <= max_id, F.lit(False)))
    keys = [F.when(valid, F.col(name)).alias(name) for name in CONTEST_KEY]
    return c.select(*keys).groupBy(*CONTEST_KEY).agg(F.count(F.lit(1)).alias("copies"))


def unknown_ids(keys: DataFrame, entities: DataFrame) -> DataFrame:
    """Ids the contests mention that no stored entity has: (entity_id).

    The ids are made distinct in the map tasks first, so this shuffles far less than
    the contests themselves, and its result is small wherever the data is mostly sound.
    """
    ids = keys.unpivot([], CONTEST_KEY, "role", ENTITY_ID).select(ENTITY_ID)
    mentioned = ids.filter(F.col(ENTITY_ID).isNotNull()).distinct()
    return mentioned.join(entities.select(ENTITY_ID), ENTITY_ID, "left_anti")


def classify_contests(keys: DataFrame, entities: DataFrame, existing: DataFrame, *, missing: str | None = None) -> DataFrame:
    """Give every key of a batch its load status.

    ``missing`` names a column for the smallest unknown id of a contest.

    ``keys`` comes from batch_keys; ``existing`` is the stored table or the part of it that
    existing_contests found. Status is one of out_of_range, unknown_entity, present and new. The rows
    to insert and the load report are both read off this one frame.

    One join looks up all ids; whether one is unknown and whether the contest is stored is then
    settled in one aggregation by key, to which the stored contests come as marked rows.
    """
    nothing = F.lit(None).cast("bigint")
    there = existing.select(*CONTEST_KEY, nothing.alias("copies"), nothing.alias("_missing"), F.lit(True).alias("_there"))
    checked = _checked(keys, entities).select(*CONTEST_KEY, "copies", F.when(F.col("unknown"), F.col(ENTITY_ID)).alias("_missing"), F.lit(False).alias("_there"))
    folded = checked.unionByName(there).groupBy(*CONTEST_KEY).agg(F.max("copies").alias("copies"), F.min("_missing").alias("_missing"), F.max("_there").alias("_there"))
    status = (
        F.when(F.col(FIRST_ID).isNull(), F.lit("out_of_range"))
        .when(F.col("_missing").isNotNull(), F.lit("unknown_entity"))
        .when(F.col("_there"), F.lit("present"))
        .otherwise(F.lit("new"))
    )
    more = [F.col("_missing").alias(missing)] if missing else []
    return folded.filter(F.col("copies").isNotNull()).select(*CONTEST_KEY, "copies", status.alias("status"), *more)


def contests_to_insert(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("status") == "new").select(*CONTEST_KEY)


def contest_load_counts() -> list[Column]:
    """The counts of a load over classified contests, as aggregates.

    raw, out_of_range, unknown_entity and source_duplicates count rows; unique_valid,
    already_present and inserted count distinct contests.
    """
    status, copies = F.col("status"), F.col("copies")
    valid = status.isin("present", "new")
    return [
        _total(copies).alias("raw"),
        _total(F.when(status == "out_of_range", copies)).alias("out_of_range"),
        _total(F.when(status == "unknown_entity", copies)).alias("unknown_entity"),
        _total(F.when(valid, F.greatest(copies - 1, F.lit(0)))).alias("source_duplicates"),
        F.count_if(valid).alias("unique_valid"),
        F.count_if(status == "present").alias("already_present"),
        F.count_if(status == "new").alias("inserted"),
    ]


def contest_load_report(classified: DataFrame) -> DataFrame:
    """One row with the counts of a load (see contest_load_counts)."""
    return classified.agg(*contest_load_counts())


def delete_by_key(stored: DataFrame, keys: DataFrame, on: Sequence[str] = (ENTITY_ID,)) -> DataFrame:
    """The stored table without the rows whose key is listed."""
    on = list(on)
    return stored.join(keys.select(*on).distinct(), on, "left_anti")


def get_by_id(stored: DataFrame, entity_id: int) -> DataFrame:
    """The stored row with this id; the filter reaches the scan."""
    return stored.filter(F.col(ENTITY_ID) == F.lit(entity_id))


