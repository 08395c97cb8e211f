"""Operators over the categories of an entity (it may have two)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duelframe.errors import ValidationError
from duelframe.functions.columns import clean_text, clip, dtype, filled, win_rate_pct
from duelframe.operators.checks import available, not_negative, require_columns, require_rows
from duelframe.operators.grouping import top_rows_per_group
from duelframe.schemas import ENTITY_ID

LONG_COLUMNS = [ENTITY_ID, "name", "win_rate", "total_battles", "total_wins"]


def unpivot_types(
    df: DataFrame, keep: list[str], type_1_column: str = "type_1", type_2_column: str = "type_2"
) -> DataFrame:
    """One row per entity and named category; blank and missing ones are left out.

    This at most doubles the rows and needs no shuffle.
    """
    present = available(df, [type_1_column, type_2_column])
    if not present:
        raise ValidationError("no category column to unpivot")
    texts = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in present])
    rows = texts.unpivot(keep, present, "type_source", "type")
    return rows.withColumn("type", clean_text(F.col("type"))).filter(F.col("type").isNotNull())


def categories_long(metrics: DataFrame) -> DataFrame:
    """The entity's figures once per category: ..., type_source, type."""
    return unpivot_types(metrics, available(metrics, LONG_COLUMNS))


def with_win_rate_pct(long: DataFrame) -> DataFrame:
    """Rows with battles, and their win rate as a percentage."""
    wins = filled(F.col("total_wins"), dtype(long, "total_wins"))
    battles = filled(F.col("total_battles"), dtype(long, "total_battles"))
    return long.filter(F.col("total_battles") > 0).withColumn("win_rate_pct", win_rate_pct(wins, battles))


def category_list(metrics: DataFrame) -> DataFrame:
    """The categories in use, sorted."""
    return unpivot_types(metrics, []).select("type").distinct().orderBy("type")


def category_win_rate(
    metrics: DataFrame,
    *,
    type_1_column: str = "type_1",
    type_2_column: str = "type_2",
    on_empty: str = "empty",
) -> DataFrame:
    """Wins over battles per category, best first.

    Partial sums leave one row per category and task before the shuffle. With
    ``on_empty="error"`` the operator runs once up front and raises if no entity with
    battles has a category.
    """
    require_columns(metrics, [type_1_column, type_2_column, "total_battles", "total_wins"], "metrics")
    fought = metrics.filter(F.col("total_battles") > 0)
    rows = unpivot_types(fought, ["total_battles", "total_wins"], type_1_column, type_2_column)
    if on_empty == "error":
        require_rows(rows, "metrics with categories")
    totals = rows.groupBy("type").agg(
        F.sum("total_battles").cast("bigint").alias("total_battles"),
        F.sum("total_wins").cast("bigint").alias("total_wins"),
    )
    ratio = F.try_divide(F.col("total_wins").cast("double"), F.col("total_battles").cast("double"))
    rated = totals.withColumns(
        {
            "mean_win_rate": F.coalesce(clip(ratio, 0.0, 1.0), F.lit(0.0)),
            "sample_size": F.col("total_battles"),
        }
    )
    return rated.orderBy(F.col("mean_win_rate").desc(), F.col("type"))


def _pct_order(df: DataFrame) -> list:
    keys = [F.col("win_rate_pct").desc(), F.col("total_battles").desc()]
    return keys + [F.col(c).asc() for c in available(df, [ENTITY_ID, "type_source"])]


def best_by_category(metrics: DataFrame) -> DataFrame:
    """The entity with the best win rate of every category, best category first."""
    require_columns(metrics, ["total_battles", "total_wins"], "metrics")
    long = with_win_rate_pct(categories_long(metrics))
    best = top_rows_per_group(long, ["type"], _pct_order(long), 1)
    out = best.select("type", "name", "total_wins", "total_battles", "win_rate_pct")
    return out.orderBy(F.col("win_rate_pct").desc(), F.col("type"))


def top_n_by_category(metrics: DataFrame, n: int = 5, category: str | None = None) -> DataFrame:
    """The n best entities of one category, or of every category when none is named."""
    require_columns(metrics, ["total_battles", "total_wins"], "metrics")
    not_negative(n, "n")
    long = categories_long(metrics)
    if category is None:
        every = with_win_rate_pct(long)
        return top_rows_per_group(every, ["type"], _pct_order(every), n)
    one = with_win_rate_pct(long.filter(F.col("type") == F.lit(category)))
    top = one.orderBy(*_pct_order(one)).limit(n)
    window = W.partitionBy("type").orderBy(*_pct_order(one))
    return top.withColumn("position", F.row_number().over(window))
