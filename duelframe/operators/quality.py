"""Data-quality checks as one small report frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions.columns import quoted, stacked
from duelframe.functions.labels import CHECK_FAILED, CHECK_OK
from duelframe.schemas import ENTITY_ID, FIRST_ID, SECOND_ID, WINNER_ID

# --- fixed values: names of the checks ---
NULL_ID = "pokemon_id nulo"
DUPLICATE_ID = "pokemon_id duplicado"
NULL_WINNER = "winner nulo"
OUTSIDE_WINNER = "winner fora do par"
SUM_BATTLES = "soma total_battles"
SUM_WINS = "soma total_wins"
# --- end of fixed values ---


def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def entity_key_counts(entities: DataFrame, id_column: str = ENTITY_ID) -> DataFrame:
    """One row: entity_rows, null_ids, duplicate_ids (rows beyond the first per key, NULL included).

    Rows are counted per key with map-side partial counts, then the counts are summed.
    """
    if id_column not in entities.columns:
        return entities.agg(
            F.count(F.lit(1)).alias("entity_rows"),
            F.lit(0).cast("bigint").alias("null_ids"),
            F.lit(0).cast("bigint").alias("duplicate_ids"),
        )
    per_key = entities.groupBy(id_column).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        _sum(F.col("n")).alias("entity_rows"),
        _sum(F.when(F.col(id_column).isNull(), F.col("n"))).alias("null_ids"),
        _sum(F.col("n") - 1).alias("duplicate_ids"),
    )


def winner_counts(contests: DataFrame) -> DataFrame:
    """One row: contest_rows, null_winners, outside_winners. A missing winner is outside too."""
    if WINNER_ID not in contests.columns:
        null, outside = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    else:
        inside = F.col(WINNER_ID).isin(F.col(FIRST_ID), F.col(SECOND_ID))
        null = F.count_if(F.col(WINNER_ID).isNull())
        outside = F.count_if(~F.coalesce(inside, F.lit(False)))
    return contests.agg(
        F.count(F.lit(1)).alias("contest_rows"),
        null.alias("null_winners"),
        outside.alias("outside_winners"),
    )


def total_counts(metrics: DataFrame) -> DataFrame:
    """One row: sum_battles, sum_wins."""
    return metrics.agg(
        _sum(F.col("total_battles")).alias("sum_battles"), _sum(F.col("total_wins")).alias("sum_wins")
    )


def side_by_side(parts: list[DataFrame]) -> DataFrame:
    """One-row frames side by side, by union and max, as a join would have no key."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def quality_report(
    entities: DataFrame, contests: DataFrame, metrics: DataFrame, *, id_column: str = ENTITY_ID
) -> DataFrame:
    """The six checks as (check, result, status); no rows if a table is empty."""
    row = side_by_side([entity_key_counts(entities, id_column), winner_counts(contests), total_counts(metrics)])
    checks = [
        (NULL_ID, "null_ids", "0"),
        (DUPLICATE_ID, "duplicate_ids", "0"),
        (NULL_WINNER, "null_winners", "0"),
        (OUTSIDE_WINNER, "outside_winners", "0"),
        (SUM_BATTLES, "sum_battles", "2 * contest_rows"),
        (SUM_WINS, "sum_wins", "contest_rows"),
    ]
    ok, failed = quoted(CHECK_OK), quoted(CHECK_FAILED)
    rows = [
        (quoted(name), value, f"CASE WHEN {value} = {expected} THEN {ok} ELSE {failed} END")
        for name, value, expected in checks
    ]
    filled = row.filter("entity_rows > 0 AND contest_rows > 0")
    return filled.select(stacked(rows, ["check", "result", "status"]))
