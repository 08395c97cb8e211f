"""Correlation of attributes with outcomes, and what is read off it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duelframe.functions import labels as lb
from duelframe.functions.columns import (
    clip, dtype, format_fixed, named, quoted, round_to, stacked, to_double,
)
from duelframe.operators.checks import not_negative, require_columns
from duelframe.schemas import OUTCOME_COLUMNS, STAT_COLUMNS


def _numeric(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    return metrics.select(*[to_double(named(c), dtype(metrics, c)).alias(c) for c in names])


#: Pairs whose states fit into one row of an aggregation; its code grows with them.
MOST_PAIRS = 48


def _moments(metrics: DataFrame, stats: list[str], outcomes: list[str], more: Sequence[Column] = ()) -> DataFrame:
    """One row with r{i}_{j} and n{i}_{j} for attribute i and outcome j and what else is asked for, also without input.

    Every task keeps one state for all pairs: their counts, means and co-moments, which merge pairwise. So a row of
    metrics is read once as it is, one row per task is shuffled, and figures that lie far from zero lose no digits.
    r uses rows where both are present and is NULL for a constant column, where the
    built-in corr divides by zero and raises under ANSI mode.
    """
    names = list(dict.fromkeys(outcomes + stats))
    numbers = metrics.withColumns({c: to_double(named(c), dtype(metrics, c)) for c in names})
    found = list(more)
    for i, s in enumerate(stats):
        for j, m in enumerate(outcomes):
            x, y = named(s), named(m)
            spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
            found.append(clip(F.try_divide(F.regr_sxy(y, x), spread), -1.0, 1.0).alias(f"r{i}_{j}"))
            found.append(F.regr_count(y, x).alias(f"n{i}_{j}"))
    return numbers.agg(*found)


def _by_rows(metrics: DataFrame, stats: list[str], outcomes: list[str]) -> DataFrame:
    """stat, metric, r, n for many pairs: each row is taken apart into its pairs, aggregated by pair.

    The same states as in _moments, one per pair and task, but nothing in the plan grows with the number of pairs.
    """
    numbers = _numeric(metrics, list(dict.fromkeys(outcomes + stats)))
    # Copies under names of their own, as a column may be both attribute and outcome.
    numbers = numbers.select(
        *[named(s).alias(f"s{i}") for i, s in enumerate(stats)],
        *[named(m).alias(f"m{j}") for j, m in enumerate(outcomes)],
    )
    m_names = [f"m{j}" for j in range(len(outcomes))]
    by_stat = numbers.unpivot(m_names, [f"s{i}" for i in range(len(stats))], "_s", "x")
    pairs = by_stat.unpivot(["_s", "x"], m_names, "_m", "y")
    spread = F.sqrt(F.regr_sxx("y", "x")) * F.sqrt(F.regr_syy("y", "x"))
    found = pairs.groupBy("_s", "_m").agg(
        clip(F.try_divide(F.regr_sxy("y", "x"), spread), -1.0, 1.0).alias("r"), F.regr_count("y", "x").alias("n")
    )
    names = metrics.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, stats))).alias("i", "stat"))
    names = names.select("*", F.posexplode(F.array(*map(F.lit, outcomes))).alias("j", "metric"))
    names = names.withColumns({"_s": F.concat(F.lit("s"), "i"), "_m": F.concat(F.lit("m"), "j")})
    joined = names.join(found, ["_s", "_m"], "left")
    return joined.select("stat", "metric", "r", F.coalesce("n", F.lit(0)).alias("n"))


def attribute_correlation(
    metrics: DataFrame,
    *,
    metric_columns: Sequence[str] = OUTCOME_COLUMNS,
    stat_columns: Sequence[str] = STAT_COLUMNS,
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Pearson r and pair count for every attribute and outcome: (stat, metric, r, n).

    ``more`` names further aggregates over the metrics, which come from the same pass and stand in every row.
    """
    more = more or {}
    stats, outcomes = list(stat_columns), list(metric_columns)
    require_columns(metrics, outcomes + stats, "metrics")
    if len(stats) * len(outcomes) > MOST_PAIRS and not more:
        return _by_rows(metrics, stats, outcomes)
    rows = [
        F.struct(F.lit(s).alias("stat"), F.lit(m).alias("metric"), F.col(f"r{i}_{j}").alias("r"), F.col(f"n{i}_{j}").alias("n"), *[F.col(c) for c in more])
        for i, s in enumerate(stats)
        for j, m in enumerate(outcomes)
    ]
    found = _moments(metrics, stats, outcomes, [c.alias(n) for n, c in more.items()])
    return found.select(F.inline(F.array(*rows)))


def correlation_matrix(
    metrics: DataFrame,
    *,
    metric_columns: Sequence[str] = OUTCOME_COLUMNS,
    stat_columns: Sequence[str] = STAT_COLUMNS,
) -> DataFrame:
    """The same correlations as a matrix: one row per attribute, one column per outcome."""
    stats, outcomes = list(stat_columns), list(metric_columns)
    require_columns(metrics, outcomes + stats, "metrics")
    if len(stats) * len(outcomes) > MOST_PAIRS:
        found = _by_rows(metrics, stats, outcomes)
        return found.groupBy("stat").agg(*[F.max(F.when(F.col("metric") == m, F.col("r"))).alias(m) for m in outcomes])
    rows = [
        F.struct(F.lit(s).alias("stat"), *[F.col(f"r{i}_{j}").alias(m) for j, m in enumerate(outcomes)])
        for i, s in enumerate(stats)
    ]
    return _moments(metrics, stats, outcomes).select(F.inline(F.array(*rows)))


def influence(
    correlations: DataFrame, metric: str = "win_rate", labels: Mapping[str, str] = lb.STAT_LABELS
) -> DataFrame:
    """Attributes by strength of their correlation with one outcome.

    The input has one row per attribute, so the windows here see a handful of rows.
    """
    known = correlations.filter((F.col("metric") == metric) & F.col("r").isNotNull())
    strength = F.abs("r")
    strongest = W.partitionBy("metric").orderBy(strength.desc(), F.col("stat"))
    weakest = W.partitionBy("metric").orderBy(strength.asc(), F.col("stat"))
    return known.select(
        "stat",
        lb.label(F.col("stat"), labels).alias("label"),
        "r",
        strength.alias("strength"),
        lb.correlation_tier(F.col("r")).alias("tier"),
        lb.direction(F.col("r")).alias("direction"),
        F.row_number().over(strongest).alias("position"),
        F.row_number().over(weakest).alias("position_from_least"),
        F.count(F.lit(1)).over(W.partitionBy("metric")).alias("ranked"),
    )


def top_attribute(
    correlations: DataFrame,
    *,
    metric: str = "win_rate",
    default_label: str | None = None,
    default_r: float | None = None,
    labels: Mapping[str, str] = lb.STAT_LABELS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row (label, r): the most influential attribute, or the defaults if there is none.

    ``keep`` names further columns of the correlations, the same in all rows, that the row is to have.
    """
    known = (F.col("metric") == metric) & F.col("r").isNotNull()
    # Smaller names win ties, which max_by alone would leave open.
    best = F.min(F.when(known, F.struct((-F.abs("r")).alias("s"), F.col("stat"), F.col("r"))))
    row = correlations.agg(best.alias("best"), *[F.max(c).alias(c) for c in keep])
    return row.select(
        *keep,
        F.coalesce(lb.label(F.col("best.stat"), labels), F.lit(default_label).cast("string")).alias("label"),
        F.coalesce(F.col("best.r"), F.lit(default_r).cast("double")).alias("r"),
    )


def influence_extremes(correlations: DataFrame, metric: str = "win_rate") -> DataFrame:
    """The most, second most and least influential attribute."""
    ranked = influence(correlations, metric)
    second = F.least(F.lit(2), F.col("ranked"))
    roles = F.array_compact(
        F.array(
            F.when(F.col("position") == 1, F.lit("most")),
            F.when(F.col("position") == second, F.lit("second")),
            F.when(F.col("position_from_least") == 1, F.lit("least")),
        )
    )
    return ranked.select(
        F.explode(roles).alias("role"), "stat", "label", "r", format_fixed(F.col("r"), 2).alias("r_text")
    )


def top_correlations(correlations: DataFrame, n: int = 5, metric: str = "win_rate") -> DataFrame:
    """The n strongest correlations with their direction."""
    ranked = influence(correlations, metric).filter(F.col("position") <= not_negative(n, "n"))
    return ranked.select(
        "position", "stat", "label", "r", format_fixed(F.col("r"), 3).alias("r_text"), "direction"
    ).orderBy("position")


def influence_table(correlations: DataFrame, metric: str = "win_rate") -> DataFrame:
    """Attribute labels with the strength of their correlation, rounded to two digits."""
    ranked = influence(correlations, metric)
    return ranked.select("position", "label", round_to(F.col("strength"), 2).alias("correlation")).orderBy("position")


def attribute_profile(metrics: DataFrame, labels: Mapping[str, str] = lb.PROFILE_LABELS) -> DataFrame:
    """Mean of the profile attributes, scaled so that the largest mean is 100.

    An absent column counts as 0; if no mean is positive all are scaled to 0.
    """
    present = [c for c in labels if c in metrics.columns]
    numbers = _numeric(metrics, present)
    position = {c: i for i, c in enumerate(labels)}
    # The counting aggregate also keeps the one result row where no column is present.
    means = numbers.agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(named(c)).alias(f"v{position[c]}") for c in present]
    )
    values = {c: f"v{position[c]}" if c in present else "0D" for c in labels}
    top = f"array_max(array({', '.join(values.values())}))"
    rows = [
        (quoted(c), quoted(labels[c]), v, f"CASE WHEN {top} > 0 THEN try_divide({v}, {top}) * 100 ELSE 0D END")
        for c, v in values.items()
    ]
    return means.select(stacked(rows, ["stat", "label", "mean", "scaled"]))
