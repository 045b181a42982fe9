from .aggregates import game_aggregates
from .attach import attach_by_key, review_features, review_features_loo
from .encoding import FeatureModel, feature_pipeline, fit_features, game_index, training_frame
from .features import (
    feature_columns,
    fill_numeric,
    flatten_sentiment,
    purchase_label,
    select_columns,
    vote_flags,
    vote_split,
)
from .metrics import auc_binned, auc_exact
from .quality import first_valid_rows, preview, record_count, sentiment_label_counts
from .rescoring import score_again
from .sampling import (
    nth_smallest,
    sample_equal_rows,
    sample_exact,
    smallest_rows,
    split_by_key,
    split_random,
)
from .scoring import score_reviews, score_reviews_batch, score_reviews_by_dictionary

__all__ = [
    "FeatureModel",
    "attach_by_key",
    "auc_binned",
    "auc_exact",
    "feature_columns",
    "feature_pipeline",
    "fill_numeric",
    "first_valid_rows",
    "fit_features",
    "flatten_sentiment",
    "game_aggregates",
    "game_index",
    "nth_smallest",
    "preview",
    "purchase_label",
    "record_count",
    "review_features",
    "review_features_loo",
    "sample_equal_rows",
    "sample_exact",
    "score_again",
    "score_reviews",
    "score_reviews_batch",
    "score_reviews_by_dictionary",
    "select_columns",
    "sentiment_label_counts",
    "smallest_rows",
    "split_by_key",
    "split_random",
    "training_frame",
    "vote_flags",
    "vote_split",
]
