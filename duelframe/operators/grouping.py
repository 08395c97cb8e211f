"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Scan partitions that meet in one task per level, and levels before the last: for a million partitions.
SHARES, LEVELS = 128, 2


def top_rows_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, position: str = "position"
) -> DataFrame:
    """The first n rows of every group, numbered from 1; a missing key is a group too.

    For n up to Spark's group-limit threshold every map task keeps only its own first n
    rows of a group, so a group holding a third of the table shuffles a few rows per
    task. Beyond the threshold Spark leaves that step out; then a group is limited level by
    level, first within scan partitions, then within ever larger bundles of SHARES of them,
    so that no task gets more than SHARES times n rows of a group.
    """
    spark = df.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        # A partition holds the same rows when it is computed again, so the number of the
        # partition is a safe salt on executor loss, unlike a row number or a random value.
        df = df.withColumn("_share", F.spark_partition_id())
        for _ in range(LEVELS):
            local = F.row_number().over(W.partitionBy(*keys, "_share").orderBy(*order))
            df = df.withColumn("_local", local).filter(F.col("_local") <= n).drop("_local")
            df = df.withColumn("_share", F.floor(F.col("_share") / SHARES))
        df = df.drop("_share")
    numbered = df.withColumn(position, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(position) <= n)
