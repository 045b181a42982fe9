"""Column names and types of the review data model.

The names below are part of the data contract: input files and downstream
readers use exactly these spellings.
"""

from pyspark.sql import types as T

# --- fixed values: column names of the input and output frames ---------------
GAME = "game"
TEXT = "review"
VOTE = "voted_up"
PURCHASE = "steam_purchase"
SENTIMENT = "sentiment_analysis"
POSITIVE_SCORE = "positive_score"
NEGATIVE_SCORE = "negative_score"

AUTHOR_AND_COMMENT_COLUMNS = [
    "author_num_games_owned",
    "author_num_reviews",
    "author_playtime_forever",
    "author_playtime_last_two_weeks",
    "author_playtime_at_review",
    "comment_count",
]
NUMERIC_COLUMNS = AUTHOR_AND_COMMENT_COLUMNS + [POSITIVE_SCORE, NEGATIVE_SCORE]
PREPARED_COLUMNS = [
    GAME,
    "author_num_games_owned",
    "author_num_reviews",
    "author_playtime_forever",
    "author_playtime_last_two_weeks",
    "author_playtime_at_review",
    "language",
    "comment_count",
    SENTIMENT,
    PURCHASE,
    VOTE,
]
AGGREGATE_COLUMNS = [
    "avg_positive_score",
    "avg_negative_score",
    "total_reviews",
    "total_positive_reviews",
    "total_negative_reviews",
]

# --- fixed values: sentiment labels ------------------------------------------
POSITIVE, NEGATIVE, NEUTRAL, ERROR = "POSITIVE", "NEGATIVE", "NEUTRAL", "ERROR"

# Column that pandas leaves behind in Parquet files written from an indexed frame.
STRAY_INDEX = "__index_level_0__"

# --- fixed values: types of the input and of the sentiment struct -------------
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField(GAME, T.StringType()),
        T.StructField(TEXT, T.StringType()),
        T.StructField("language", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in AUTHOR_AND_COMMENT_COLUMNS],
        T.StructField(VOTE, T.BooleanType()),
        T.StructField(PURCHASE, T.BooleanType()),
    ]
)

SENTIMENT_TYPE = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("score", T.FloatType()),
        T.StructField(POSITIVE_SCORE, T.FloatType()),
        T.StructField(NEGATIVE_SCORE, T.FloatType()),
    ]
)
