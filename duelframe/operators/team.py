"""Category-diverse team selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions.columns import clean_text, named
from duelframe.operators.checks import positive, require_columns
from duelframe.operators.grouping import top_rows_per_group
from duelframe.operators.ranking import descending
from duelframe.schemas import ENTITY_ID


def diverse_top_n(
    metrics: DataFrame,
    *,
    team_size: int = 6,
    score_column: str = "weighted_score",
    diversity_by_type: bool = True,
    type_1_column: str = "type_1",
    id_column: str = ENTITY_ID,
) -> DataFrame:
    """The best entities by score with at most one per category, topped up by score.

    Going down the scores and skipping categories already taken keeps exactly the best
    entity of each category, and every entity without one. So no loop is needed: the
    first ``team_size`` of those, then the best of the others if they are too few. The
    others that can be needed are all among the best ``team_size`` overall.

    Entities without category are one group of the window; like every category it is cut
    to ``team_size`` rows in each map task before the shuffle. After that no frame has
    more than ``team_size`` rows.
    """
    positive(team_size, "team_size")
    require_columns(metrics, [score_column], "metrics")
    order = descending(metrics, score_column, id_column=id_column)
    overall = metrics.orderBy(*order).limit(team_size)
    if not diversity_by_type or type_1_column not in metrics.columns:
        return overall

    rows = metrics.withColumn("_category", clean_text(named(type_1_column)))
    best = top_rows_per_group(rows, ["_category"], order, team_size, "_rn")
    firsts = best.filter((F.col("_rn") == 1) | F.col("_category").isNull()).select(*metrics.columns)
    firsts = firsts.orderBy(*order).limit(team_size)
    # A row that is in both frames is a first; what is left of the overall best is fill.
    both = firsts.withColumn("_first", F.lit(1)).unionByName(overall.withColumn("_first", F.lit(0)))
    first_copies = F.sum("_first").cast("int")
    copies = both.groupBy(*metrics.columns).agg(
        first_copies.alias("_f"), F.greatest(F.count(F.lit(1)).cast("int") - 2 * first_copies, F.lit(0)).alias("_o")
    )
    marks = F.concat(F.array_repeat(F.lit(0), F.col("_f")), F.array_repeat(F.lit(1), F.col("_o")))
    team = copies.select(*metrics.columns, F.explode(marks).alias("_fill"))
    return team.orderBy("_fill", *order).limit(team_size).drop("_fill")
