"""Contest analytics on Spark: outcome metrics, rankings, categories, teams and loads."""

from duelframe.errors import ConcurrentLoadError, ValidationError
from duelframe.operators.categories import (
    best_by_category, categories_long, category_list, category_win_rate, top_n_by_category,
)
from duelframe.operators.clean import clean_contests, clean_entities
from duelframe.operators.correlation import (
    attribute_correlation, attribute_profile, correlation_matrix, influence, influence_extremes,
    influence_table, top_attribute, top_correlations,
)
from duelframe.operators.metrics import outcome_counts, outcome_metrics
from duelframe.operators.quality import quality_report
from duelframe.operators.ranking import ranking, ranking_positions, top_win_rate
from duelframe.operators.team import diverse_top_n
from duelframe.plans.pipeline import (
    delete_contests, delete_entities, load_contests, load_entities, run_pipeline, store_metrics, stored_metrics,
)

__all__ = [
    "ConcurrentLoadError", "ValidationError", "attribute_correlation", "attribute_profile", "best_by_category",
    "categories_long", "category_list", "category_win_rate", "clean_contests", "clean_entities",
    "correlation_matrix", "delete_contests", "delete_entities", "diverse_top_n", "influence", "influence_extremes", "influence_table",
    "load_contests", "load_entities", "outcome_counts", "outcome_metrics", "quality_report",
    "ranking", "ranking_positions", "run_pipeline", "store_metrics", "stored_metrics", "top_attribute", "top_correlations",
    "top_n_by_category", "top_win_rate",
]
