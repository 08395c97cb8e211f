"""Display-ready frames behind the dashboard panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duelframe.functions import labels as lb
from duelframe.functions.columns import format_fixed
from duelframe.operators import categories as cat
from duelframe.operators import correlation as corr
from duelframe.operators.checks import available
from duelframe.operators.metrics import counts_and_totals, with_rates
from duelframe.operators.team import diverse_top_n
from duelframe.schemas import ENTITY_ID, METRIC_COLUMNS, STAT_COLUMNS


def kpi_summary(
    entities: DataFrame,
    contests: DataFrame,
    *,
    metric: str = "win_rate",
    stat_columns: Sequence[str] = STAT_COLUMNS,
    default_label: str | None = None,
    default_r: float | None = None,
    digits: int = 9,
) -> DataFrame:
    """One row: total entities, contests and victories, and the top attribute with its r, rounded to ``digits``.

    Both tables are read once: the totals over the contests are a row of their own among the battles and wins per id,
    which the entities are joined with, and all is aggregated in one pass.
    """
    counts = counts_and_totals(contests).withColumnRenamed(ENTITY_ID, "_id")
    mine = entities.drop(*METRIC_COLUMNS).withColumn("_entity", F.lit(1))
    joined = mine.join(counts, mine[ENTITY_ID] == counts["_id"], "full_outer").fillna(0, ["total_battles", "total_wins"])
    totals = {
        "total_entities": F.count("_entity"),
        "total_contests": F.coalesce(F.max("contests"), F.lit(0)),
        "total_victories": F.coalesce(F.max("victories"), F.lit(0)),
    }
    found = corr.attribute_correlation(with_rates(joined), metric_columns=[metric], stat_columns=stat_columns, more=totals)
    found = found.withColumn("r", F.round("r", digits))
    top = corr.top_attribute(found, metric=metric, default_label=default_label, default_r=default_r, keep=list(totals))
    row = top.withColumnsRenamed({"label": "top_attribute", "r": "top_attribute_r"})
    return row.withColumn("top_attribute_r_text", format_fixed(F.col("top_attribute_r"), 2))


def correlation_bars(
    correlations: DataFrame, metric: str = "win_rate", labels: Mapping[str, str] = lb.STAT_LABELS
) -> DataFrame:
    """Bars of the correlation chart, weakest first."""
    ranked = corr.influence(correlations, metric, labels)
    return ranked.select(
        "label", "strength", "r", format_fixed(F.col("r"), 2).alias("r_text"), "tier"
    ).orderBy("strength", "label")


def win_rate_by_type(metrics: DataFrame) -> DataFrame:
    """The best entity of every category, lowest rate first."""
    return cat.best_by_category(metrics).orderBy(F.col("win_rate_pct").asc(), F.col("type"))


def top_cards(metrics: DataFrame, category: str, n: int = 5) -> DataFrame:
    """The best entities of one category with position, rate text and tier."""
    top = cat.top_n_by_category(metrics, n, category)
    return top.select(
        "position", "name", "win_rate_pct",
        format_fixed(F.col("win_rate_pct"), 1, "%").alias("win_rate_text"),
        lb.win_rate_tier(F.col("win_rate_pct")).alias("tier"),
    ).orderBy("position")


def team_cards(metrics: DataFrame, team_size: int = 6) -> DataFrame:
    """The suggested team, most wins first, with type labels and score text."""
    wanted = [ENTITY_ID, "name", "type_1", "type_2", *METRIC_COLUMNS]
    # Only the columns shown go through the selection.
    shown = metrics.select(*available(metrics, wanted))
    team = diverse_top_n(shown, team_size=team_size).fillna("", ["name", "type_1", "type_2"])
    order = [F.col("total_wins").desc(), F.col(ENTITY_ID).asc()]
    first, second = F.col("type_1"), F.col("type_2")
    short = F.concat(first, F.when(second != "", F.concat(F.lit("/"), second)).otherwise(F.lit("")))
    score = F.col("weighted_score")
    return team.orderBy(*order).limit(team_size).select(
        F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order)).alias("position"),
        ENTITY_ID, "name",
        short.alias("type_label"),
        lb.joined_types(first, second).alias("type_text"),
        "total_wins", "total_battles", "weighted_score",
        F.when(score > 0, F.concat(F.lit("Score: "), format_fixed(score, 1))).otherwise(F.lit("")).alias("score_text"),
    )


def diagnostics(metrics: DataFrame, category: str, n: int = 10) -> DataFrame:
    """The best entities of one category with the counts behind their rates."""
    top = cat.top_n_by_category(metrics, n, category)
    return top.select("position", "name", "type", "total_wins", "total_battles", "win_rate_pct").orderBy("position")


def diagnostic_message(metrics: DataFrame, category: str) -> DataFrame:
    """One row with the sentence about the best entity of a category."""
    best = cat.top_n_by_category(metrics, 1, category)
    return best.select(
        lb.best_row_message(
            F.col("name"), F.col("total_wins"), F.col("total_battles"), F.col("win_rate_pct")
        ).alias("message")
    )


def win_rate_table(rates: DataFrame) -> DataFrame:
    """Any frame with win_rate_pct as a labelled table, highest rate first."""
    wanted = ["type", "name", "total_wins", "total_battles", "win_rate_pct"]
    tie = [F.col(c).asc() for c in available(rates, ["type", "name"])]
    shown = rates.orderBy(F.col("win_rate_pct").desc(), *tie).select(*available(rates, wanted))
    texts = shown.withColumn("win_rate_pct", format_fixed(F.col("win_rate_pct"), 2, "%"))
    return texts.withColumnsRenamed(lb.TABLE_LABELS)
