"""Score rankings and thresholded top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions.columns import dtype, missing_last, named
from duelframe.operators.checks import not_negative, require_columns
from duelframe.operators.positions import with_positions
from duelframe.schemas import ENTITY_ID


def descending(df: DataFrame, *names: str, id_column: str = ENTITY_ID) -> list[Column]:
    """Sort order: the named columns downwards with what is missing last, then the id.

    Equal scores are common (rates of small counts), so the id settles every tie.
    """
    order = [missing_last(named(n), dtype(df, n)).desc_nulls_last() for n in names]
    return order + ([named(id_column).asc()] if id_column in df.columns else [])


def ranking(
    metrics: DataFrame,
    *,
    score_column: str = "weighted_score",
    top_n: int | None = None,
    id_column: str = ENTITY_ID,
) -> DataFrame:
    """All entities by score, best first; with ``top_n`` only the first ones.

    Without a limit this is a range-partitioned sort; with one each task keeps its own
    best rows and only those are merged.
    """
    require_columns(metrics, [score_column], "metrics")
    ordered = metrics.orderBy(*descending(metrics, score_column, id_column=id_column))
    return ordered if top_n is None else ordered.limit(not_negative(top_n, "top_n"))


def top_win_rate(
    metrics: DataFrame,
    *,
    win_rate_column: str = "win_rate",
    min_battles_column: str = "total_battles",
    min_battles: int = 1,
    top_n: int = 10,
    id_column: str = ENTITY_ID,
) -> DataFrame:
    """Best win rates among entities with enough battles."""
    require_columns(metrics, [win_rate_column, min_battles_column], "metrics")
    eligible = metrics.filter(named(min_battles_column) >= F.lit(int(min_battles)))
    order = descending(eligible, win_rate_column, id_column=id_column)
    return eligible.orderBy(*order).limit(not_negative(top_n, "top_n"))


def ranking_positions(
    metrics: DataFrame,
    folder: str,
    *,
    score_column: str = "weighted_score",
    position: str = "position",
    id_column: str = ENTITY_ID,
) -> DataFrame:
    """All entities with their place in the whole ranking, from 1; the id settles ties.

    ``folder`` is a new one on shared storage, for the ranges of the order.
    """
    require_columns(metrics, [score_column], "metrics")
    return with_positions(metrics, descending(metrics, score_column, id_column=id_column), folder, name=position)
