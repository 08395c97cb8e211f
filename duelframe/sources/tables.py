"""Stored tables on shared storage.

Entities and contests lie in folders that are written once; commits (sources/commits.py) say which of them count, so a
load counts as a whole or not at all. Entities are cut into ranges of ids with a folder each, and a load writes the
ranges anew that it has ids in. Contests are added to: a batch is a folder of its own, sorted by key, with the
battles and wins it adds beside it; deletions are folders of keys that hold for what was there before. Contests that
wait are filed by the id they wait for. Other tables are replaced as a whole, a version folder each, and a version
counts from the moment Spark's commit leaves its _SUCCESS marker.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.errors import ValidationError
from duelframe.operators.metrics import outcome_counts
from duelframe.schemas import CONTEST, CONTEST_KEY, ENTITY, ENTITY_ID, FIRST_ID, QUARANTINE, SECOND_ID
from duelframe.sources import commits
from duelframe.sources.commits import remove

#: Versions of a table that are kept.
KEPT_VERSIONS = 2
#: Entities in a range of ids; a range is cut once it has twice as many. Ranges at most that a load cuts one into.
RANGE_ROWS, MOST_CUTS = 1_000_000, 4096
#: Bytes of a row group of contests: the least that is read for a key.
ROW_GROUP = 8 << 20
#: Different ids by which row groups are looked up. A batch with more of them reads by their least and largest id.
LOOKED_UP = 10_000
#: Folders of counts, and of waiting contests, that are read together before a load merges them.
MERGED = 16
#: Tasks at most that list the folders of a table.
LISTERS = 64
COUNT = T.StructType([T.StructField(c, T.LongType()) for c in (ENTITY_ID, "total_battles", "total_wins")])
WAITING = T.StructType([*CONTEST.fields, T.StructField("missing", T.LongType(), False)])


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    mapper: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Scan a stored table under its declared schema, optionally projected and mapped."""
    df = spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))
    if columns is not None:
        df = df.select(*columns)
    return mapper(df) if mapper else df


def _found(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in (found or []))


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions, oldest first."""
    return [found.removesuffix("/_SUCCESS") for found in _found(spark, f"{path}/version-*/_SUCCESS")]


def latest_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete version, or None before the first load."""
    return (versions(spark, path) or [None])[-1]


def publish_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write the frame as the next version of the table and return its folder.

    KEPT_VERSIONS are kept for readers that have begun; older ones are deleted.
    """
    spark = df.sparkSession
    newest = latest_version(spark, path)
    number = int(newest.rsplit("-", 1)[1]) + 1 if newest else 1
    target = f"{path}/version-{number:08d}"
    # A folder without marker under this number is what a failed load left behind.
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    for old in versions(spark, path)[:-KEPT_VERSIONS]:
        remove(spark, old)
    return target


# --- entities: ranges of ids ---


def entity_ranges(spark: SparkSession, warehouse: str) -> commits.Commit:
    """The ranges of the entity table: folder, low (the least id that belongs there, any for the first range) and rows."""
    return commits.newest(spark, f"{warehouse}/entities")


def _read_folders(spark: SparkSession, table: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LISTERS)))  # or else a task per folder lists them
    try:
        return read_table(spark, [f"{table}/{folder}" for folder in folders], schema)
    finally:
        spark.conf.set(name, before)


def read_entities(spark: SparkSession, warehouse: str, ranges: Sequence[int] | None = None, at: commits.Commit | None = None) -> DataFrame:
    """The stored entities, of the ranges with these numbers only if named; an empty frame before the first load."""
    found = (at or entity_ranges(spark, warehouse)).entries
    found = found if ranges is None else [found[i] for i in ranges if i < len(found)]
    return _read_folders(spark, f"{warehouse}/entities", [e["folder"] for e in found], ENTITY)


def range_of(lows: Sequence[int], c: Column) -> Column:
    """The number of the range an id is in: how many of the rising `lows` are not above it, by halving."""
    if not lows:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(lows).bit_length()))])
    bounds = F.array(*[F.lit(x).cast("bigint") for x in lows])

    def go_on(at: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(bounds, at + step - 1) <= c, F.lit(False)), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), go_on)


def _lows(entries: Sequence[dict]) -> list[int]:
    return [e["low"] for e in entries[1:]]


def ranges_with(ids: DataFrame, at: commits.Commit) -> dict[int, int]:
    """Rows per range that the given ids (entity_id) fall into; a row per range comes to the driver."""
    counted = ids.groupBy(range_of(_lows(at.entries), F.col(ENTITY_ID)).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    return {r["n"]: r["rows"] for r in counted.collect()}


def _cut(entries: Sequence[dict], touched: dict[int, int], rows: DataFrame, range_rows: int) -> list[int]:
    """The lows with those added that cut ranges of too many rows into even ones, by quantiles of the ids in `rows`."""
    sizes = {n: new + (entries[n]["rows"] if n < len(entries) else 0) for n, new in touched.items()}
    pieces = {n: min(MOST_CUTS, -(-size // range_rows)) for n, size in sizes.items() if size > 2 * range_rows}
    lows = _lows(entries)
    if not pieces:
        return lows
    most = max(pieces.values())
    number = range_of(lows, F.col(ENTITY_ID))
    steps = F.percentile_approx(ENTITY_ID, [k / most for k in range(1, most)], 10 * most).alias("at")
    found = rows.groupBy(number.alias("n")).agg(steps).where(F.col("n").isin(list(pieces)))
    added = {r["at"][k * most // pieces[r["n"]] - 1] for r in found.collect() for k in range(1, pieces[r["n"]])}
    return sorted({*lows, *added})


def replace_ranges(spark: SparkSession, warehouse: str, at: commits.Commit, touched: dict[int, int], rows: DataFrame, range_rows: int = RANGE_ROWS) -> commits.Commit:
    """Commit `rows` as all entities of the touched ranges (number: rows that came in), the other ranges as they are.

    `rows` is read more than once if a range has to be cut.
    """
    table = f"{warehouse}/entities"
    lows = _cut(at.entries, touched, rows, range_rows)
    name = commits.new_folder("rows")
    placed = rows.select(*ENTITY.fieldNames()).withColumn("part", range_of(lows, F.col(ENTITY_ID)))
    placed.repartition("part").sortWithinPartitions("part", ENTITY_ID).write.partitionBy("part").parquet(f"{table}/{name}")
    kept = [e for n, e in enumerate(at.entries) if n not in touched]
    written = _read_folders(spark, table, [name], T.StructType([ENTITY[ENTITY_ID], T.StructField("part", T.IntegerType())]))
    sizes = written.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).collect()  # a row per range
    made = [{"folder": f"{name}/part={r['part']}", "low": lows[r["part"] - 1] if r["part"] else None, "rows": r["rows"]} for r in sizes]
    entries = sorted([*kept, *made], key=lambda e: (e["low"] is not None, e["low"] or 0))
    return commits.commit(spark, table, at, entries)


def publish_entities(df: DataFrame, warehouse: str, range_rows: int = RANGE_ROWS) -> None:
    """Make the frame, which has one row per id, the whole entity table."""
    spark = df.sparkSession
    at = entity_ranges(spark, warehouse)
    empty = commits.Commit(at.number, ())
    replace_ranges(spark, warehouse, empty, ranges_with(df, empty), df, range_rows)


# --- contests: batches ---


def contest_batches(spark: SparkSession, warehouse: str) -> commits.Commit:
    """The batches of the contest table, oldest first: folder, kind (add or delete) and counts (a folder)."""
    return commits.newest(spark, f"{warehouse}/contests")


def lookup(keys: DataFrame, names: Sequence[str] = (FIRST_ID, SECOND_ID)) -> Column | None:
    """A condition on stored rows that all of the given keys meet, for Parquet to skip row groups by; None for no keys.

    Ids are compared with a row group's bounds and dictionary. At most LOOKED_UP ids of a column come to the driver.
    """
    conditions = []
    for name in names:
        ids = [r[name] for r in keys.select(name).where(F.col(name).isNotNull()).distinct().limit(LOOKED_UP + 1).collect()]
        if not ids:
            return None
        low, high = (min(ids), max(ids)) if len(ids) <= LOOKED_UP else keys.agg(F.min(name), F.max(name)).first()
        conditions.append(f"{name} BETWEEN {low}L AND {high}L")
        if len(ids) <= LOOKED_UP:
            conditions.append(f"{name} IN ({', '.join(f'{x}L' for x in ids)})")
    return F.expr(" AND ".join(conditions))


def read_contests(spark: SparkSession, warehouse: str, condition: Column | None = None, at: commits.Commit | None = None) -> DataFrame:
    """The stored contests, those that meet the condition only if there is one; an empty frame before the first load.

    Batches are read together up to a deletion, which holds for what was there before.
    """
    table = f"{warehouse}/contests"
    found, here = None, []

    def batch(folders: list[str]) -> DataFrame:
        rows = _read_folders(spark, table, folders, CONTEST)
        return rows if condition is None else rows.where(condition)

    def joined() -> DataFrame:
        if found is None:
            return batch(here)
        return found.unionByName(batch(here)) if here else found

    for entry in (at or contest_batches(spark, warehouse)).entries:
        if entry["kind"] == "add":
            here.append(entry["folder"])
        else:
            found, here = joined().join(batch([entry["folder"]]), CONTEST_KEY, "left_anti"), []
    return joined()


def write_contests(df: DataFrame, path: str) -> None:
    """Write contests in the order of their keys, in row groups that can be skipped by key."""
    ordered = df.select(*CONTEST_KEY).repartitionByRange(*CONTEST_KEY).sortWithinPartitions(*CONTEST_KEY)
    ordered.write.option("parquet.block.size", ROW_GROUP).parquet(path)


def _with_counts(spark: SparkSession, table: str, rows: DataFrame, sign: int, before: Sequence[dict]) -> tuple[str, list[dict]]:
    """Write what the rows add to battles and wins; with the counts of the entries `before` once they are many."""
    name = commits.new_folder("counts")
    counts = outcome_counts(rows).select(ENTITY_ID, *[(F.col(c) * sign).cast("bigint").alias(c) for c in COUNT.names[1:]])
    folders = [e["counts"] for e in before if e.get("counts")]
    if len(folders) >= MERGED:
        counts = _summed(counts.unionByName(_read_folders(spark, table, folders, COUNT)))
        before = [{k: v for k, v in e.items() if k != "counts"} for e in before]
    counts.write.parquet(f"{table}/{name}")
    return name, list(before)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy(ENTITY_ID).agg(*[F.sum(c).alias(c) for c in COUNT.names[1:]])


def change_contests(spark: SparkSession, warehouse: str, at: commits.Commit, rows: DataFrame, kind: str = "add") -> commits.Commit:
    """Commit a batch of contests, which are not stored yet, or a deletion of contests that are."""
    table = f"{warehouse}/contests"
    name = commits.new_folder(kind)
    write_contests(rows, f"{table}/{name}")
    rows = _read_folders(spark, table, [name], CONTEST)
    counts, before = _with_counts(spark, table, rows, 1 if kind == "add" else -1, at.entries)
    return commits.commit(spark, table, at, [*before, {"kind": kind, "folder": name, "counts": counts}])


def read_counts(spark: SparkSession, warehouse: str) -> DataFrame:
    """entity_id, total_battles, total_wins over all stored contests, from the counts of the batches; no contest is read."""
    folders = [e["counts"] for e in contest_batches(spark, warehouse).entries if e.get("counts")]
    return _summed(_read_folders(spark, f"{warehouse}/contests", folders, COUNT))


def compact_contests(spark: SparkSession, warehouse: str) -> None:
    """Write all stored contests anew as one batch, without what has been deleted."""
    at = contest_batches(spark, warehouse)
    table, name, counts = f"{warehouse}/contests", commits.new_folder("add"), commits.new_folder("counts")
    write_contests(read_contests(spark, warehouse, at=at), f"{table}/{name}")
    folders = [e["counts"] for e in at.entries if e.get("counts")]
    _summed(_read_folders(spark, table, folders, COUNT)).write.parquet(f"{table}/{counts}")
    commits.commit(spark, table, at, [{"kind": "add", "folder": name, "counts": counts}])


# --- contests that wait for an entity ---


def waiting_batches(spark: SparkSession, warehouse: str) -> commits.Commit:
    return commits.newest(spark, f"{warehouse}/waiting")


def read_waiting(spark: SparkSession, warehouse: str, condition: Column | None = None, at: commits.Commit | None = None) -> DataFrame:
    """Contests that name an entity that is not stored yet, with the id each waits for in `missing`; once for each load that had it."""
    table = f"{warehouse}/waiting"
    found = spark.createDataFrame([], WAITING)
    for entry in (at or waiting_batches(spark, warehouse)).entries:
        rows = _read_folders(spark, table, [entry["folder"]], WAITING)
        rows = rows if condition is None else rows.where(condition)
        found = found.unionByName(rows) if entry["kind"] == "add" else found.join(rows.select("missing"), "missing", "left_anti")
    return found.select(*WAITING.fieldNames())


def change_waiting(spark: SparkSession, warehouse: str, rows: DataFrame, kind: str = "add") -> commits.Commit:
    """Commit contests that wait, or ids (missing) whose contests wait no longer. Many folders are merged first."""
    table = f"{warehouse}/waiting"
    at = waiting_batches(spark, warehouse)
    entries = list(at.entries)
    if len(entries) >= MERGED:
        merged = commits.new_folder("add")
        _write_waiting(read_waiting(spark, warehouse, at=at).distinct(), f"{table}/{merged}")
        entries = [{"kind": "add", "folder": merged}]
    name = commits.new_folder(kind)
    if kind == "delete":
        rows = rows.select(*[F.lit(0).cast("bigint").alias(c) for c in CONTEST_KEY], "missing")
    _write_waiting(rows.select(*WAITING.fieldNames()), f"{table}/{name}")
    return commits.commit(spark, table, at, [*entries, {"kind": kind, "folder": name}])


def _write_waiting(rows: DataFrame, path: str) -> None:
    order = ["missing", *CONTEST_KEY]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", ROW_GROUP).parquet(path)


# --- what loads set aside ---


def set_aside(rows: DataFrame, warehouse: str, source: str, batch: str) -> None:
    """Keep what a load could not use: (page, pos, reason, text) of one source and batch; a repeated batch replaces it."""
    rows.select(*QUARANTINE.fieldNames()).write.mode("overwrite").parquet(f"{warehouse}/quarantine/batch={batch}/source={source}")


def read_quarantine(spark: SparkSession, warehouse: str) -> DataFrame:
    """All that was set aside: page, pos, reason, text, batch, source."""
    schema = T.StructType([*QUARANTINE.fields, T.StructField("batch", T.StringType()), T.StructField("source", T.StringType())])
    path = f"{warehouse}/quarantine"
    if not _found(spark, path):
        return spark.createDataFrame([], schema)
    return read_table(spark, path, schema)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder the session names in spark.checkpoint.dir.

    Only a local session may do without the setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValidationError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="duelframe-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
