"""Outcome metrics per entity: battles, wins, win rate and weighted score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.errors import ValidationError
from duelframe.functions import columns as fn
from duelframe.operators.checks import require_columns, require_rows
from duelframe.operators.clean import clean_contests
from duelframe.schemas import CONTEST_KEY, ENTITY_ID, FIRST_ID, METRIC_COLUMNS, SECOND_ID, WINNER_ID


def keyed_contests(
    contests: DataFrame, first_column: str, second_column: str, winner_column: str
) -> DataFrame:
    """Contests under the canonical names, whatever the caller's names are."""
    mapping = {first_column: FIRST_ID, second_column: SECOND_ID, winner_column: WINNER_ID}
    moved = {k: v for k, v in mapping.items() if k != v and k in contests.columns}
    out = clean_contests(contests.withColumnsRenamed(moved) if moved else contests)
    require_columns(out, CONTEST_KEY, "contests")
    return out.select(*CONTEST_KEY)


def outcome_counts(
    contests: DataFrame,
    *,
    first_column: str = FIRST_ID,
    second_column: str = SECOND_ID,
    winner_column: str = WINNER_ID,
) -> DataFrame:
    """Battles and wins per id, from one pass over the contests and one shuffle.

    Each contest is unpivoted into its three roles and aggregated once. The partial
    aggregation in front of the shuffle leaves at most one row per id and task, so an
    entity that takes part in a third of all contests is no heavier than any other.
    """
    pairs = keyed_contests(contests, first_column, second_column, winner_column)
    roles = pairs.unpivot([], CONTEST_KEY, "role", ENTITY_ID).filter(F.col(ENTITY_ID).isNotNull())
    won = F.col("role") == WINNER_ID
    return roles.groupBy(ENTITY_ID).agg(
        F.sum(F.when(won, F.lit(0)).otherwise(F.lit(1))).alias("total_battles"),
        F.sum(F.when(won, F.lit(1)).otherwise(F.lit(0))).alias("total_wins"),
    )


def counts_and_totals(contests: DataFrame) -> DataFrame:
    """Like outcome_counts, from the same pass, with one more row: no id, and all contests and victories in ``contests`` and ``victories``."""
    c = keyed_contests(contests, FIRST_ID, SECOND_ID, WINNER_ID)

    def role(id_: Column | None, battles: int, wins: int) -> Column:
        here = {"contests": F.lit(0), "victories": F.lit(0)}
        if id_ is None:
            here = {"contests": F.lit(1), "victories": F.col(WINNER_ID).isNotNull().cast("int")}
        values = {ENTITY_ID: F.lit(None).cast("bigint") if id_ is None else id_, "total_battles": F.lit(battles), "total_wins": F.lit(wins), **here}
        return F.struct(*[v.alias(n) for n, v in values.items()])

    roles = c.select(F.inline(F.array(role(F.col(FIRST_ID), 1, 0), role(F.col(SECOND_ID), 1, 0), role(F.col(WINNER_ID), 0, 1), role(None, 0, 0))))
    roles = roles.filter(F.col(ENTITY_ID).isNotNull() | (F.col("contests") == 1))
    return roles.groupBy(ENTITY_ID).agg(*[F.sum(n).alias(n) for n in ("total_battles", "total_wins", "contests", "victories")])


def total_battles(
    contests: DataFrame, *, first_column: str = FIRST_ID, second_column: str = SECOND_ID
) -> DataFrame:
    """Appearances on either side per id."""
    sides = contests.select(F.col(first_column).alias(FIRST_ID), F.col(second_column).alias(SECOND_ID))
    ids = sides.unpivot([], [FIRST_ID, SECOND_ID], "role", ENTITY_ID).filter(F.col(ENTITY_ID).isNotNull())
    return ids.groupBy(ENTITY_ID).agg(F.count(F.lit(1)).alias("total_battles"))


def total_wins(contests: DataFrame, *, winner_column: str = WINNER_ID) -> DataFrame:
    """Wins per id."""
    winners = contests.select(F.col(winner_column).alias(ENTITY_ID)).filter(F.col(ENTITY_ID).isNotNull())
    return winners.groupBy(ENTITY_ID).agg(F.count(F.lit(1)).alias("total_wins"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add win rate and weighted score to a frame with battles and wins."""
    battles, wins = F.col("total_battles"), F.col("total_wins")
    rated = counts.withColumn("win_rate", fn.win_rate(battles, wins))
    return rated.withColumn("weighted_score", fn.weighted_score(F.col("win_rate"), battles))


def outcome_metrics(
    entities: DataFrame,
    contests: DataFrame,
    *,
    id_column: str = ENTITY_ID,
    legendary_column: str = "legendary",
    first_column: str = FIRST_ID,
    second_column: str = SECOND_ID,
    winner_column: str = WINNER_ID,
    on_empty: str = "error",
) -> DataFrame:
    """Every entity row with its battles, wins, win rate and weighted score.

    ``on_empty="error"`` looks for a first row in both inputs before planning and
    raises if there is none; ``"zero"`` stays lazy and gives zeros. Entities without
    contests get zeros; repeated entity rows all get the full figures.
    """
    require_columns(entities, [id_column, legendary_column], "entities")
    if on_empty not in ("error", "zero"):
        raise ValidationError("on_empty is 'error' or 'zero'")
    counts = outcome_counts(
        contests, first_column=first_column, second_column=second_column, winner_column=winner_column
    )
    if on_empty == "error":
        require_rows(entities, "entities")
        require_rows(contests, "contests")
    return with_counts(entities, counts, id_column=id_column)


def with_counts(entities: DataFrame, counts: DataFrame, *, id_column: str = ENTITY_ID) -> DataFrame:
    """Every entity row with the battles and wins that ``counts`` has for its id, and the rates that follow."""
    base = entities.drop(*METRIC_COLUMNS)
    if not isinstance(fn.dtype(base, id_column), T.LongType):
        base = base.withColumn(id_column, fn.to_long(fn.named(id_column), fn.dtype(base, id_column)))
    counts = counts.withColumnRenamed(ENTITY_ID, id_column)
    joined = base.join(counts, id_column, "left").fillna(0, ["total_battles", "total_wins"])
    return with_rates(joined).select(*base.columns, *METRIC_COLUMNS)
