"""Numbers for all rows of an order, without bringing them into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bits that `monotonically_increasing_id` gives to the row within its partition.
ROW_BITS = 33


def with_positions(
    df: DataFrame, order: Sequence[Column], folder: str, *, name: str = "position", by: Sequence[str] = (), total: str | None = None
) -> DataFrame:
    """``df`` with the place of each row in the given order, from 1, per group of the ``by`` columns if named.
    ``total`` names a column for the number of rows of the group.

    The rows are cut into ranges of the order, sorted within them and written to ``folder``, a new one that all
    executors share; a row's place is then its place in its range plus the rows of the ranges before. Only one
    count per range and group is added up. Ranges are also cut by where a row was read, so rows that are equal
    in the whole order, a third of all for example, don't meet in one task; they get places in any order.
    A null is a group of its own. A folder is used once: the places hold for as long as it stays.
    """
    spark = df.sparkSession
    keys = [*[F.col(c).asc_nulls_first() for c in by], *order]
    groups = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    cut = df.repartitionByRange(*keys, F.spark_partition_id()).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = cut.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"), *groups, F.spark_partition_id().alias("_part"), at.alias("_at"))
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    group_names = [f"_by{i}" for i in range(len(by))]
    counts = placed.groupBy("_part", *group_names).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = W.partitionBy(*group_names).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "_part",
        *group_names,
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"),
        F.sum("_n").over(W.partitionBy(*group_names)).alias("_total"),
    )
    same = placed["_part"] == starts["_part"]
    for c in group_names:
        same = same & placed[c].eqNullSafe(starts[c])
    # Without groups there is one start per range, as many as shuffle partitions.
    joined = placed.join(starts if by else F.broadcast(starts), same)
    totals = [F.col("_total").alias(total)] if total else []
    return joined.select("_row.*", (F.col("_start") + F.col("_at") + 1).alias(name), *totals)
