"""Game index, one-hot encoding, scaling and the feature vector."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import (
    AGGREGATE_COLUMNS,
    GAME,
    NEGATIVE_SCORE,
    POSITIVE_SCORE,
    PURCHASE,
    VOTE,
)
from ..shared import materialise
from .attach import attach_by_key, leave_one_out
from .features import purchase_label

INDEX, ENCODED, SCALED, FEATURES = "game_index", "game_encoded", "scaled", "features"
WEIGHT = "weight"
# How the game itself becomes a feature: a slot per game, one column of category
# numbers, or not at all.
ONE_HOT, CATEGORY, NO_GAME = "one_hot", "category", "none"


def running_total_before(value: str, order: str):
    """Sum of ``value`` over the rows before this one.

    Runs in one task, so it is meant for a table of one row per partition.
    """
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def game_index(df: DataFrame, game: str = GAME) -> DataFrame:
    """(game, game_index) from 0, by frequency in ``df``, ties by name.

    Null games get no row; their index is the number of games. The order is built
    by range partitions: each is numbered by itself and shifted by the sizes of
    those before it, so no task and not the driver holds all games.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_n").desc(), F.col(game).asc()]
    counts = df.where(F.col(game).isNotNull()).groupBy(game).agg(F.count(F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange(parts, *order)
    # Written out because range bounds are drawn anew each time a plan runs.
    ranged = materialise(ranged.withColumn("_part", F.spark_partition_id()), "game_index")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_part", running_total_before("_size", "_part").alias("_start"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    # One row per partition, hence at most ``parts`` rows to broadcast.
    return (
        ranged.select(game, "_part", within.alias("_within"))
        .join(F.broadcast(starts), "_part")
        .select(game, (F.col("_within") + F.col("_start")).cast("bigint").alias(INDEX))
    )


def feature_pipeline(
    n_games: int, one_hot: bool = True, single_row: bool = False, game_as: str | None = None
) -> Pipeline:
    """Stages from aggregates and index to ``features``: five scaled, then the game.

    ``game_as`` is ``"one_hot"`` (default), ``"category"`` or ``"none"`` (the default without
    ``one_hot``). A category is one more value, the game's index: vectors stay six wide
    however many games there are, and trees split the games into any two sets.

    Only the five aggregates are scaled. One-hot slots already span 0 to 1, so
    scaling would not change them and would make each row as wide as there are
    games. With a single row there is one constant slot, which scales to 0.5.
    """
    game_as = _game_as(game_as, one_hot)
    stages = [
        VectorAssembler(inputCols=AGGREGATE_COLUMNS, outputCol="aggregates"),
        MinMaxScaler(inputCol="aggregates", outputCol=SCALED),
    ]
    parts = [SCALED]
    if game_as == ONE_HOT and n_games:
        if single_row:
            stages.append(SQLTransformer(statement=f"SELECT *, 0.5D AS {ENCODED} FROM __THIS__"))
        else:
            stages.append(OneHotEncoder(inputCol=INDEX, outputCol=ENCODED))
        parts.append(ENCODED)
    elif game_as == CATEGORY:
        parts.append(INDEX)
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol=FEATURES)])


def _game_as(game_as: str | None, one_hot: bool) -> str:
    game_as = game_as or (ONE_HOT if one_hot else NO_GAME)
    if game_as not in (ONE_HOT, CATEGORY, NO_GAME):
        raise ValueError(f"game_as: {game_as}")
    return game_as


@dataclass
class FeatureModel:
    """Fitted features: the per-game table, the stages and the number of games."""

    per_game: DataFrame
    stages: PipelineModel
    n_games: int
    game_as: str = ONE_HOT

    def transform(self, df: DataFrame) -> DataFrame:
        """Encode rows that hold the aggregates and the index."""
        known = F.coalesce(F.col(INDEX), F.lit(self.n_games).cast("bigint"))
        rows = df.na.fill(0, AGGREGATE_COLUMNS).withColumn(INDEX, known)
        encoded = self.stages.transform(rows)
        # One attribute name per game would end up in the footer of every file; trees
        # only need to know that the last value is a category, and of how many.
        return encoded.withMetadata(FEATURES, self.metadata())

    def metadata(self) -> dict:
        if self.game_as != CATEGORY:
            return {}
        last = len(AGGREGATE_COLUMNS)
        category = {"idx": last, "name": INDEX, "num_vals": self.n_games + 1}
        return {"ml_attr": {"attrs": {"nominal": [category]}, "num_attrs": last + 1}}

    def encode_games(self) -> DataFrame:
        """The per-game table with its encoded columns."""
        return self.transform(self.per_game)

    def vector_of_no_game(self) -> DataFrame:
        """One row: the features of a game that the model was not fitted on."""
        zeros = [F.lit(0).cast(self.per_game.schema[c].dataType).alias(c) for c in AGGREGATE_COLUMNS]
        nothing = self.per_game.sparkSession.range(1)
        nothing = nothing.select(*zeros, F.lit(self.n_games).cast("bigint").alias(INDEX))
        return self.transform(nothing).select(FEATURES)


def fit_features(
    aggs: DataFrame, one_hot: bool = True, game_as: str | None = None
) -> FeatureModel:
    """Fit index, encoder and scaler on one row per game; see ``feature_pipeline``."""
    game_as = _game_as(game_as, one_hot)
    aggs = materialise(aggs, "aggregates")
    index = materialise(game_index(aggs), "indexed")
    rows, n_games = aggs.count(), index.count()
    named = index.withColumnRenamed(GAME, "_game")
    joined = aggs.join(named, F.col(GAME) == F.col("_game"), "left").drop("_game")
    known = F.coalesce(F.col(INDEX), F.lit(n_games).cast("bigint"))
    per_game = materialise(joined.withColumn(INDEX, known), "per_game")
    # Tells the encoder the number of categories, the one for unknown games included.
    categories = {"ml_attr": {"type": "nominal", "num_vals": n_games + 1}}
    fit_on = per_game.withMetadata(INDEX, categories)
    stages = feature_pipeline(n_games, single_row=rows == 1, game_as=game_as).fit(fit_on)
    return FeatureModel(per_game, stages, n_games, game_as)


def review_vectors(
    df: DataFrame,
    model: FeatureModel,
    others_only: bool = False,
    on_unscored: str = "zero",
    aggregated=None,
    **join_options,
) -> DataFrame:
    """``df`` with ``features``.

    ``others_only`` leaves the review itself out of its game's aggregates, where it is one
    of those that ``aggregated``, a condition, names as part of them (default: all).
    """
    if others_only:
        columns = df.columns
        rows = attach_by_key(df, model.per_game, written=True, **join_options)
        encoded = model.transform(leave_one_out(rows, on_unscored, aggregated))
        return encoded.select(*columns, FEATURES)
    # All reviews of a game share its vector: encode games, not reviews.
    vectors = model.encode_games().select(GAME, FEATURES)
    rows = attach_by_key(df, vectors, sizes=model.per_game, **join_options)
    known = F.coalesce(F.col(FEATURES), model.vector_of_no_game().scalar())
    return rows.withColumn(FEATURES, known).withMetadata(FEATURES, model.metadata())


def training_frame(
    df: DataFrame,
    model: FeatureModel,
    keep: Sequence[str] = (),
    others_only: bool = False,
    on_unscored: str = "zero",
    grain: str = "review",
    weighted: bool = False,
    **join_options,
) -> DataFrame:
    """``keep``, ``features`` and ``label``.

    ``grain="review"`` gives one row per review, labelled with its own purchase
    flag; ``others_only`` leaves the review itself out of its game's aggregates.
    ``grain="game"`` gives one row per game, labelled 1 if at least half of its
    reviews come with a purchase.

    ``weighted`` gives one row per distinct example with its number of copies as
    ``weight``. Features follow from the game and, with ``others_only``, from the
    review's own vote and scores. Reviews alike in those are counted first, so the
    join and the encoding work on a few rows per game.
    """
    if grain not in ("review", "game"):
        raise ValueError(f"grain: {grain}")
    label = purchase_label(F.col(PURCHASE))
    if grain == "game":
        rate = df.groupBy(F.col(GAME).alias("_game")).agg(F.avg(label).alias("_rate"))
        rows = model.encode_games().join(rate, F.col(GAME).eqNullSafe(F.col("_game")))
        rows = rows.withColumn("label", F.when(F.col("_rate") >= 0.5, 1).otherwise(0))
        rows = rows.withColumn(WEIGHT, F.lit(1))
    else:
        own = [VOTE, POSITIVE_SCORE, NEGATIVE_SCORE] if others_only else []
        own += ["scored"] if others_only and on_unscored == "exclude" else []
        rows = df.select(*dict.fromkeys([*keep, GAME, *own]), label.alias("label"))
        if weighted:
            rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(WEIGHT))
        rows = review_vectors(rows, model, others_only, on_unscored, **join_options)
    columns = [*keep, FEATURES, "label"]
    if not weighted:
        return rows.select(*columns)
    return rows.groupBy(*columns).agg(F.sum(WEIGHT).cast("double").alias(WEIGHT))
