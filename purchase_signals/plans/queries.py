"""The registered queries: each takes (spark, folder of tables)."""

from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import parse_score_response, polarity, words_of
from ..functions.text import clean_json_line, clean_text, is_missing, run_stamp, truncate_text
from ..operators.aggregates import game_aggregates
from ..operators.attach import attach_by_key, review_features, review_features_loo
from ..operators.encoding import CATEGORY, fit_features, game_index, training_frame
from ..operators.features import (
    feature_columns,
    fill_numeric,
    flatten_sentiment,
    purchase_label,
    select_columns,
    vote_flags,
    vote_split,
)
from ..operators.metrics import auc_exact
from ..operators.quality import first_valid_rows, preview, record_count, sentiment_label_counts
from ..operators.sampling import sample_equal_rows, sample_exact, split_by_key
from ..operators.scoring import (
    score_reviews,
    score_reviews_batch,
    score_reviews_by_dictionary,
)
from ..schema import AGGREGATE_COLUMNS, PURCHASE, SENTIMENT, STRAY_INDEX, VOTE
from ..shared import materialise, shared_path
from ..sinks.parquet import append_load, run_path, write_parquet, write_sample, write_train_val
from ..sources.dump import register
from ..sources.json_array import read_json_array
from ..sources.json_text import parse_json_lines, read_json_document
from ..sources.lake import extract_to_lake
from ..sources.reviews import read_all_runs, read_latest_run, read_reviews
from . import jobs, training
from .ingest import load_json, read_loaded, read_rejected
from .inputs import (
    TEST_NEGATIVE,
    TEST_POSITIVE,
    reviews,
    reviews_fact,
    spread,
    table,
    benchmark_scorer,
)
from .model import PurchaseModel, save_purchase_model
from .preparation import score_run

PROPS_SCHEMA = "k bigint"
SENTIMENT_FIELDS = ["label", "score", "positive_score", "negative_score"]


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    """Averages depend on the order of summing in their last bits."""
    return df.withColumns(
        {c: F.round(c, digits) for c, t in df.dtypes if t == "double" and c != "score"}
    )


def struct_fields(df: DataFrame, column: str = SENTIMENT) -> DataFrame:
    return df.select("review_id", *[F.col(f"{column}.{f}").alias(f) for f in SENTIMENT_FIELDS])


def scored_reviews(spark, sf_dir: str) -> DataFrame:
    return score_reviews(reviews(spark, sf_dir), benchmark_scorer)


def flat_reviews(spark, sf_dir: str, with_scored: bool = False) -> DataFrame:
    chosen = select_columns(scored_reviews(spark, sf_dir), keep=["review_id"])
    return fill_numeric(flatten_sentiment(chosen, with_scored))


def json_lines(spark, sf_dir: str) -> DataFrame:
    """Lines of a JSON array file, some of them blank, cut short or no objects."""
    n = F.col("event_id")
    line = (
        F.when(n % 19 == 0, F.lit("["))
        .when(n % 23 == 0, F.lit("]"))
        .when(n % 29 == 0, F.lit("   "))
        .when(n % 31 == 0, F.concat(F.substring("props", 1, 5), F.lit(",")))
        .when(n % 37 == 0, F.lit("5,"))
        .otherwise(F.concat(F.lit("  "), "props", F.lit(", \t")))
    )
    return table(spark, sf_dir, "events").select("event_id", line.alias("value"))


# sources


def q_read_reviews(spark, sf_dir):
    path = shared_path(spark, "reviews")
    write_parquet(reviews(spark, sf_dir).withColumn(STRAY_INDEX, F.col("review_id")), path)
    return read_reviews(spark, path)


def _two_runs(spark, sf_dir):
    """Odd reviews in an older run, even ones in a newer, and a run cut short."""
    root = shared_path(spark, "runs")
    rows = reviews(spark, sf_dir).select("review_id", "game", "language")
    write_parquet(rows.where("review_id % 2 = 1"), run_path(root, "run", datetime(2024, 1, 2)))
    write_parquet(rows.where("review_id % 2 = 0"), run_path(root, "run", datetime(2024, 1, 3)))
    cut_short = rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    cut_short.parquet(run_path(root, "run", datetime(2024, 1, 4)))
    return root


def q_read_all_runs(spark, sf_dir):
    return read_all_runs(spark, _two_runs(spark, sf_dir))


def q_read_latest_run(spark, sf_dir):
    return read_latest_run(spark, _two_runs(spark, sf_dir))


def q_json_lines_lenient(spark, sf_dir):
    good, _ = parse_json_lines(json_lines(spark, sf_dir), PROPS_SCHEMA)
    return good


def q_json_document(spark, sf_dir):
    """Files of one JSON array each, for every thousand event numbers."""
    path = shared_path(spark, "json")
    event = F.struct("event_id", "event_type", "value")
    files = table(spark, sf_dir, "events").groupBy(F.expr("event_id div 1000").alias("file"))
    documents = files.agg(F.to_json(F.collect_list(event)).alias("document"))
    documents.write.partitionBy("file").text(path)
    schema = "event_id bigint, event_type string, value double"
    return read_json_document(spark, path, schema).drop("file")


def q_json_array(spark, sf_dir):
    """One file that is one line: an array of events with texts that look like JSON."""
    path = shared_path(spark, "array")
    text = F.concat(F.lit('} ] "'), "event_type", F.lit("\\ {"))
    event = F.to_json(F.struct("event_id", text.alias("text"), F.array(F.struct("value")).alias("items")))
    events = table(spark, sf_dir, "events").select(F.concat(event, F.lit(",")).alias("value"))
    ends = [spark.createDataFrame([(v,)], "value string") for v in ("[", "{}]")]
    # In one file, as the brackets stand at its ends.
    whole = ends[0].unionByName(events).unionByName(ends[1]).coalesce(1)
    whole.write.option("lineSep", " ").text(path)
    rows = read_json_array(spark, path, "event_id bigint, text string, items array<struct<value: double>>")
    return rows.select("event_id", "text", F.col("items")[0]["value"].alias("value"))


def q_extract_to_lake(spark, sf_dir):
    landing, lake = shared_path(spark, "landing"), shared_path(spark, "lake")
    rows = reviews(spark, sf_dir).select("review_id", "game", "review", VOTE)
    rows.write.json(landing)
    extract_to_lake(spark, "json", {"path": landing}, lake, schema=rows.schema)
    return spark.read.parquet(lake)


def q_document_dump(spark, sf_dir):
    """Two loads into a partitioned document sink, and the extract of both from it as a source."""
    fmt, path, lake = register(spark), shared_path(spark, "dump"), shared_path(spark, "lake")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", F.struct("value", F.array("props").alias("texts")).alias("held")
    )
    for part in (rows.where("event_id % 2 = 0"), rows):
        append_load(spread(part), path, fmt)
    schema = f"{rows.schema.toDDL()}, uploaded_at timestamp"
    extract_to_lake(spark, fmt, {"path": path, "range_bytes": "100000"}, lake, schema=schema)
    found = spark.read.parquet(lake).where("uploaded_at is not null")
    texts = F.col("held.texts")[0].alias("props")
    return found.select("event_id", "event_type", run_stamp(F.col("ts")).alias("stamp"), "held.value", texts)


# sinks


def q_write_roundtrip(spark, sf_dir):
    path = write_parquet(scored_reviews(spark, sf_dir), shared_path(spark, "scored"))
    return struct_fields(spark.read.parquet(path))


def q_write_train_val(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn("label", purchase_label(F.col(PURCHASE)))
    columns = ("review_id", "game", "label")
    train, val = write_train_val(rows, shared_path(spark, "halves"), "review_id", columns)
    halves = [
        spark.read.parquet(path).select("*", F.lit(name).alias("part"))
        for path, name in ((train, "train"), (val, "validation"))
    ]
    return halves[0].unionByName(halves[1])


def q_append_load(spark, sf_dir):
    path = shared_path(spark, "collection")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for part in (rows.where("event_id % 2 = 0"), rows):
        append_load(part, path)
    return spark.read.parquet(path).where(F.col("uploaded_at").isNotNull()).drop("uploaded_at")


def q_write_sample(spark, sf_dir):
    rows = reviews(spark, sf_dir).select("review_id", "game")
    return spark.read.parquet(write_sample(rows, "review_id", shared_path(spark, "sample")))


def _lines_file(spark, sf_dir):
    """A file of JSON lines: fields that only some documents have, that change type, and bad lines."""
    path = shared_path(spark, "lines")
    n = F.col("event_id")
    document = F.to_json(
        F.struct(
            "event_id", "event_type", F.from_json("props", PROPS_SCHEMA).alias("props"),
            F.when(n % 3 == 0, F.col("value")).alias("value"),
            F.when(n % 5 == 0, F.concat(F.lit("extra "), n)).alias("extra field"),
        )
    )
    # A number in most documents, a text in some.
    mixed = F.when(n % 7 == 0, F.lit('"odd"')).otherwise(n.cast("string"))
    line = F.concat(F.left(document, F.length(document) - 1), F.lit(',"mixed":'), mixed, F.lit("}"))
    line = (
        F.when(n % 19 == 0, F.concat(line, F.lit(" x")))
        .when(n % 23 == 0, F.left(line, F.length(line) - 1))
        .when(n % 29 == 0, F.concat(F.lit("["), n, F.lit("]")))
        .otherwise(line)
    )
    lines = spread(table(spark, sf_dir, "events")).select(F.concat(F.lit("  "), line, F.lit(",")).alias("value"))
    edges = spark.createDataFrame([("[",), ("]",), ("",)], "value string")
    lines.unionByName(edges).write.text(path)
    return path


def q_load_lines(spark, sf_dir):
    """Documents and rejected lines of two loads of one file, the second with a given schema."""
    target, source = shared_path(spark, "collection"), _lines_file(spark, sf_dir)
    first = load_json(spark, source, target, lines=True)
    second = load_json(spark, source, target, schema="event_id bigint, mixed string", lines=True)
    good = read_loaded(spark, target).drop("uploaded_at")
    good = good.select(
        "event_id", "event_type", F.col("props.k").alias("k"), "value",
        F.col("extra field").alias("extra"), "mixed", F.lit(None).cast("string").alias("line"),
    )
    bad = read_rejected(spark, target).select("line")
    totals = [first["inserted"] + second["inserted"], first["rejected"] + second["rejected"]]
    return good.unionByName(bad, allowMissingColumns=True).select(
        "*",
        F.lit(totals[0]).cast("long").alias("inserted"),
        F.lit(totals[1]).cast("long").alias("rejected"),
        F.lit(",".join(first["conflicts"])).alias("conflicts"),
    )


def q_sample_lines(spark, sf_dir):
    """Lines without a key, many of them equal, sampled by what they hold."""
    lines = json_lines(spark, sf_dir).select(clean_json_line(F.col("value")).alias("line"))
    return sample_equal_rows(lines, "line", 300)


# quality and preview


def q_json_quarantine(spark, sf_dir):
    _, bad = parse_json_lines(json_lines(spark, sf_dir), PROPS_SCHEMA)
    return bad


def q_preview(spark, sf_dir):
    return preview(table(spark, sf_dir, "events").drop("ts"), "event_id")


def q_record_count(spark, sf_dir):
    good, _ = parse_json_lines(json_lines(spark, sf_dir), PROPS_SCHEMA)
    return record_count(good)


def q_sentiment_label_counts(spark, sf_dir):
    return sentiment_label_counts(scored_reviews(spark, sf_dir))


# projections, filters, nulls


def q_select_columns(spark, sf_dir):
    chosen = select_columns(scored_reviews(spark, sf_dir), keep=["review_id"])
    label = F.col(f"{SENTIMENT}.label").alias("sentiment_label")
    return chosen.select("*", label).drop(SENTIMENT)


def q_flatten_sentiment(spark, sf_dir):
    chosen = select_columns(scored_reviews(spark, sf_dir), keep=["review_id"])
    return flatten_sentiment(chosen)


def q_score_reviews(spark, sf_dir):
    return struct_fields(scored_reviews(spark, sf_dir))


def q_repartition_score(spark, sf_dir):
    return struct_fields(score_reviews(reviews(spark, sf_dir), benchmark_scorer, partitions=10))


def q_score_reviews_batch(spark, sf_dir):
    positive, negative = set(TEST_POSITIVE), set(TEST_NEGATIVE)

    def make_client():
        import re

        def client(texts):
            replies = []
            for text in texts:
                words = re.split("[^a-z]+", text.lower())
                p = sum(w in positive for w in words)
                n = sum(w in negative for w in words)
                share = (p + 1) / (p + n + 2)
                label = "POSITIVE" if share >= 0.5 else "NEGATIVE"
                replies.append({"label": label, "score": max(share, 1 - share)})
            return replies

        return client

    return struct_fields(score_reviews_batch(reviews(spark, sf_dir), make_client))


def q_score_by_dictionary(spark, sf_dir):
    """Scoring by a table of words: those of the lists among all words that the texts hold."""
    words = reviews(spark, sf_dir).select(F.explode(words_of(F.col("review"))).alias("word"))
    words = words.distinct().withColumn(
        "positive",
        F.when(F.col("word").isin(TEST_POSITIVE), True).when(F.col("word").isin(TEST_NEGATIVE), False),
    )
    dictionary = words.where("positive is not null")
    scored = score_reviews_by_dictionary(reviews(spark, sf_dir), dictionary)
    return struct_fields(scored)


def q_score_again(spark, sf_dir):
    """A second run asks for the reviews that the first one could not score, and for no others.

    The first client has no answer where an odd number of its positive words occurs; the
    second one would call every review certainly positive.
    """
    positive, negative = set(TEST_POSITIVE), set(TEST_NEGATIVE)

    def make_failing():
        import re

        def client(texts):
            replies = []
            for text in texts:
                words = re.split("[^a-z]+", text.lower())
                p = sum(w in positive for w in words)
                n = sum(w in negative for w in words)
                share = (p + 1) / (p + n + 2)
                label = "POSITIVE" if share >= 0.5 else "NEGATIVE"
                replies.append(None if p % 2 else {"label": label, "score": max(share, 1 - share)})
            return replies

        return client

    def make_certain():
        return lambda texts: [{"label": "POSITIVE", "score": 1.0}] * len(texts)

    source = write_parquet(reviews(spark, sf_dir), shared_path(spark, "source"))
    root = shared_path(spark, "runs")
    score_run(spark, source, root, make_client=make_failing)
    path = score_run(spark, source, root, make_client=make_certain, key="review_id", resume=True)
    return struct_fields(spark.read.parquet(path))


def q_conditional_flags(spark, sf_dir):
    up, down = vote_flags(F.col(VOTE))
    return reviews(spark, sf_dir).select("review_id", up.alias("is_up"), down.alias("is_down"))


def q_purchase_label(spark, sf_dir):
    return reviews(spark, sf_dir).select(
        "review_id",
        purchase_label(F.col(PURCHASE)).alias("label"),
        F.col(PURCHASE).isNull().alias("unknown"),
    )


def q_feature_columns(spark, sf_dir):
    rows = reviews_fact(spark, sf_dir).withColumn("label", purchase_label(F.col(PURCHASE)))
    return rows.select(feature_columns(rows))


def q_vote_split(spark, sf_dir):
    up, down = vote_split(reviews(spark, sf_dir).select("review_id", "game", VOTE))
    return up.unionByName(down)


def q_fill_numeric(spark, sf_dir):
    return flat_reviews(spark, sf_dir)


def q_missing_text(spark, sf_dir):
    return reviews(spark, sf_dir).select(
        "review_id", is_missing(F.col("review")).alias("is_missing")
    )


def q_first_valid_rows(spark, sf_dir):
    good, _ = parse_json_lines(json_lines(spark, sf_dir), PROPS_SCHEMA)
    return first_valid_rows(good, "event_id")


# aggregations and joins


def q_game_aggregates(spark, sf_dir):
    return rounded(game_aggregates(flat_reviews(spark, sf_dir)))


def q_game_aggregates_fact(spark, sf_dir):
    return rounded(game_aggregates(reviews_fact(spark, sf_dir)))


def q_game_aggregates_exclude(spark, sf_dir):
    flat = flat_reviews(spark, sf_dir, with_scored=True)
    return rounded(game_aggregates(flat, on_unscored="exclude"))


def q_avg_sentiment_by_game(spark, sf_dir):
    aggs = game_aggregates(reviews_fact(spark, sf_dir))
    return rounded(aggs.select("game", "avg_positive_score", "avg_negative_score"))


def q_review_count_by_game(spark, sf_dir):
    return game_aggregates(reviews_fact(spark, sf_dir)).select("game", "total_reviews")


def q_votes_by_game(spark, sf_dir):
    aggs = game_aggregates(reviews_fact(spark, sf_dir))
    return aggs.select("game", "total_positive_reviews", "total_negative_reviews")


def q_review_features(spark, sf_dir):
    flat = flat_reviews(spark, sf_dir).select(
        "review_id", "game", VOTE, "positive_score", "negative_score"
    )
    return rounded(review_features(flat, game_aggregates(flat)))


def q_review_features_loo(spark, sf_dir):
    flat = flat_reviews(spark, sf_dir).select(
        "review_id", "game", VOTE, "positive_score", "negative_score"
    )
    return rounded(review_features_loo(flat, game_aggregates(flat, with_sums=True)), 6)


# sampling and split


def q_sample_200(spark, sf_dir):
    rows = reviews(spark, sf_dir).select("review_id", "game", "language", "review")
    return sample_exact(rows, "review_id")


def q_split_train(spark, sf_dir):
    rows = reviews(spark, sf_dir).select("review_id", "game", VOTE)
    return split_by_key(rows, "review_id")[0]


def q_split_val(spark, sf_dir):
    rows = reviews(spark, sf_dir).select("review_id", "game", VOTE)
    return split_by_key(rows, "review_id")[1]


# scalar functions


def q_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean_text(F.col("text")).alias("cleaned")
    )


def q_truncate_text(spark, sf_dir):
    shown = truncate_text(clean_text(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", shown.alias("shown"))


def q_clean_json_line(spark, sf_dir):
    return json_lines(spark, sf_dir).select(
        "event_id", clean_json_line(F.col("value")).alias("line")
    )


def q_json_parse(spark, sf_dir):
    parsed = F.from_json("props", PROPS_SCHEMA)
    return table(spark, sf_dir, "events").select(
        "event_id",
        parsed["k"].alias("k"),
        F.to_json(F.struct("event_type", parsed["k"].alias("k"))).alias("document"),
    )


def q_score_polarity(spark, sf_dir):
    n = F.col("event_id")
    label = F.when(n % 3 == 0, "POSITIVE").when(n % 3 == 1, "NEGATIVE").otherwise("MIXED")
    scored = polarity(label, F.pmod(n, F.lit(101)) / 100)
    rows = table(spark, sf_dir, "events").select(n.alias("review_id"), scored.alias(SENTIMENT))
    return struct_fields(rows)


def _responses(spark, sf_dir):
    """Replies of a scoring service, whole and damaged."""
    n = F.col("event_id")
    score = F.format_string("%.2f", F.pmod(n, F.lit(101)) / 100)
    reply = (
        F.when(n % 11 == 0, F.lit("[]"))
        .when(n % 11 == 1, F.lit('{"label":"POSITIVE","score":0.9}'))
        .when(n % 11 == 2, F.lit("not json"))
        .when(n % 11 == 3, F.lit('["POSITIVE"]'))
        .when(n % 11 == 4, F.lit('[{"label":"NEGATIVE"}]'))
        .when(n % 11 == 5, F.concat(F.lit('[{"score":'), score, F.lit("}]")))
        .when(n % 11 == 6, F.concat(F.lit('[{"label":"MIXED","score":'), score, F.lit("}]")))
        .when(n % 11 == 7, F.concat(F.lit('[{"label":"NEGATIVE","score":'), score, F.lit("}]")))
        .otherwise(F.concat(F.lit('[{"label":"POSITIVE","score":'), score, F.lit("}]")))
    )
    return table(spark, sf_dir, "events").select(n.alias("review_id"), reply.alias("reply"))


def q_parse_score_response(spark, sf_dir):
    rows = _responses(spark, sf_dir)
    parsed = parse_score_response(F.col("reply")).alias(SENTIMENT)
    return struct_fields(rows.select("review_id", parsed))


def q_run_stamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", run_stamp(F.col("ts")).alias("stamp"))


# features and model


def q_game_index(spark, sf_dir):
    return game_index(reviews(spark, sf_dir).select("game").distinct())


def _fact_model(spark, sf_dir, one_hot=True):
    rows = reviews_fact(spark, sf_dir)
    return rows, fit_features(game_aggregates(rows, with_sums=True), one_hot)


def q_game_one_hot(spark, sf_dir):
    _, model = _fact_model(spark, sf_dir)
    slots = vector_to_array("game_encoded")
    return model.encode_games().select(
        "game",
        (F.array_position(slots, 1.0) - 1).cast("bigint").alias("hot_slot"),
        F.size(slots).cast("bigint").alias("slots"),
    )


def q_scaled_features(spark, sf_dir):
    _, model = _fact_model(spark, sf_dir)
    values = vector_to_array("scaled")
    named = [F.round(values[i], 8).alias(f"scaled_{c}") for i, c in enumerate(AGGREGATE_COLUMNS)]
    return model.encode_games().select("game", *named)


def q_final_features(spark, sf_dir):
    _, model = _fact_model(spark, sf_dir)
    values = vector_to_array("features")
    named = [F.round(values[i], 8).alias(f"feature_{i}") for i in range(len(AGGREGATE_COLUMNS))]
    one_hot = F.slice(values, len(AGGREGATE_COLUMNS) + 1, F.size(values))
    return model.encode_games().select(
        "game",
        *named,
        (F.array_position(one_hot, 1.0) + len(named) - 1).cast("bigint").alias("hot_slot"),
        F.size(values).cast("bigint").alias("slots"),
    )


def q_training_frame(spark, sf_dir):
    rows, model = _fact_model(spark, sf_dir)
    frame = training_frame(rows, model, keep=["review_id"])
    values = vector_to_array("features")
    one_hot = F.slice(values, len(AGGREGATE_COLUMNS) + 1, F.size(values))
    return frame.select(
        "review_id",
        "label",
        *[F.round(values[i], 8).alias(f"feature_{i}") for i in range(len(AGGREGATE_COLUMNS))],
        (F.array_position(one_hot, 1.0) + len(AGGREGATE_COLUMNS) - 1).cast("bigint").alias("hot_slot"),
        F.size(values).cast("bigint").alias("slots"),
    )


def _by_popularity(spark, sf_dir):
    """Scored reviews that are purchases in games with more reviews than games have on average.

    Trees can tell these games apart by their features, so SQL can say what they predict.
    """
    rows = reviews_fact(spark, sf_dir)
    aggregates = materialise(game_aggregates(rows, with_sums=True), "aggregates")
    usual = aggregates.agg(F.avg("total_reviews")).scalar()
    popular = aggregates.select("game", (F.col("total_reviews") > usual).alias(PURCHASE))
    rows = attach_by_key(rows.drop(PURCHASE), popular, written=True)
    return rows, fit_features(aggregates, game_as=CATEGORY)


def _trained(spark, sf_dir):
    rows, features = _by_popularity(spark, sf_dir)
    train, validation = split_by_key(rows, "review_id")
    examples = training_frame(train, features, weighted=True)
    return PurchaseModel(features, training.train_gbt(examples)), validation


def _encoded(model, validation):
    frame = training_frame(validation, model.features, keep=["review_id"])
    return training.predictions(model.trees, frame)


def _margins(predicted):
    return predicted.select(
        "review_id", "label", "prediction", F.round("margin", 6).alias("margin")
    )


def q_train_gbt(spark, sf_dir):
    model, validation = _trained(spark, sf_dir)
    predicted = _encoded(model, validation)
    return predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("reviews"))


def q_predictions(spark, sf_dir):
    model, validation = _trained(spark, sf_dir)
    return _margins(_encoded(model, validation))


def q_batch_predict(spark, sf_dir):
    """Raw reviews through a model that was saved and loaded again."""
    model, validation = _trained(spark, sf_dir)
    path = shared_path(spark, "model")
    save_purchase_model(model, path)
    return _margins(training.batch_predict(validation, path, keep=["review_id"]))


def q_batch_predict_others(spark, sf_dir):
    """The same with each review left out of what its game's reviews say."""
    rows, features = _by_popularity(spark, sf_dir)
    train, validation = split_by_key(rows, "review_id")
    examples = training_frame(train, features, others_only=True, weighted=True)
    model = PurchaseModel(features, training.train_gbt(examples), others_only=True)
    path = shared_path(spark, "model")
    save_purchase_model(model, path)
    inside = F.lit(True)
    return _margins(
        training.batch_predict(validation, path, keep=["review_id"], aggregated=inside)
    )


def q_auc_exact(spark, sf_dir):
    rows = reviews_fact(spark, sf_dir).select(
        "positive_score", purchase_label(F.col(PURCHASE)).alias("label")
    )
    return rounded(auc_exact(rows, "positive_score"))


def q_end_to_end(spark, sf_dir):
    """The whole job over reviews of which those of games with many reviews are purchases."""
    rows = reviews(spark, sf_dir).drop(PURCHASE)
    sizes = materialise(rows.groupBy("game").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    usual = sizes.agg(F.avg("_n")).scalar()
    popular = sizes.select("game", (F.col("_n") > usual).alias(PURCHASE))
    rows = attach_by_key(rows, popular, written=True)
    source, out = write_parquet(rows, shared_path(spark, "source")), shared_path(spark, "job")
    report = jobs.run(spark, source, out, benchmark_scorer, key="review_id", game_as=CATEGORY)
    counted = [
        spark.read.parquet(report[part]).groupBy("label").agg(F.count(F.lit(1)).alias("reviews"))
        .select(F.lit(part).alias("part"), "label", "reviews", F.lit(None).cast("double").alias("margin"))
        for part in ("train", "validation")
    ]
    predicted = spark.read.parquet(report["predictions"])
    predicted = predicted.groupBy("label", F.round("margin", 6).alias("margin")).agg(
        F.sum("weight").cast("long").alias("reviews")
    )
    predicted = predicted.select(F.lit("predictions").alias("part"), "label", "reviews", "margin")
    rows = counted[0].unionByName(counted[1]).unionByName(predicted)
    return rows.withColumn("auc", F.lit(report["auc"]).cast("double"))


QUERIES = {name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")}
