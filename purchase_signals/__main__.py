"""spark-submit entry: sample and load raw JSON; score, prepare, train, or all three with run; predict."""

import argparse
import functools
import json

from pyspark.sql import SparkSession

from .functions.sentiment import DEFAULT_NEGATIVE, DEFAULT_POSITIVE, lexicon_scorer
from .operators.encoding import CATEGORY, NO_GAME, ONE_HOT
from .plans.ingest import load_json, preview_lines, read_rejected, sample_json
from .plans.jobs import run
from .plans.model import load_purchase_model, predict, save_purchase_model
from .plans.preparation import FEATURES_FOLDER, imported, prepare, score_run
from .plans.training import evaluate, save_model, train_gbt
from .schema import SENTIMENT, TEXT
from .shared import remove_intermediates
from .sinks.parquet import write_parquet
from .sources.dump import FORMAT, register
from .sources.lake import extract_to_lake
from .sources.reviews import read_latest_run, read_reviews


def _scorer(args):
    def words(path, default):
        if path is None:
            return default
        with open(path, encoding="utf-8") as lines:
            return lines.read().split()

    return functools.partial(
        lexicon_scorer,
        positive=words(args.positive, DEFAULT_POSITIVE),
        negative=words(args.negative, DEFAULT_NEGATIVE),
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="purchase_signals", description=__doc__)
    steps = top.add_subparsers(dest="step", required=True)

    scoring = argparse.ArgumentParser(add_help=False)
    scoring.add_argument("--positive", help="file of positive words")
    scoring.add_argument("--negative", help="file of negative words")
    scoring.add_argument("--partitions", type=int, help="spread rows before scoring")
    scoring.add_argument("--client", help="module:function that makes a model of your own")
    scoring.add_argument("--max-chars", type=int, help="with --client: cut texts to so many")
    scoring.add_argument("--max-error-share", type=float, help="more ERROR rows end the step")
    scoring.add_argument("--resume", action="store_true", help="ask for new, changed and failed reviews only")

    preparing = argparse.ArgumentParser(add_help=False)
    keyed = argparse.ArgumentParser(add_help=False)
    keyed.add_argument("--key", help="column that tells reviews apart; decides the split")
    preparing.add_argument("--no-one-hot", action="store_true")
    preparing.add_argument("--game-as", choices=[ONE_HOT, CATEGORY, NO_GAME])
    preparing.add_argument("--others-only", action="store_true")
    preparing.add_argument("--on-unscored", choices=["zero", "exclude"], default="zero")

    training = argparse.ArgumentParser(add_help=False)
    training.add_argument("--max-iter", type=int, default=50)

    step = steps.add_parser("sample")
    step.add_argument("--input", required=True, help="JSON, one object per line")
    step.add_argument("--output", required=True)
    step.add_argument("--first", type=int, default=1000, help="valid rows to sample from")
    step.add_argument("--all", action="store_true", help="sample from all valid rows")
    step.add_argument("--rows", type=int, default=200)
    step.add_argument("--seed", type=int, default=42)

    step = steps.add_parser("load")
    step.add_argument("--input", required=True, help="JSON files")
    step.add_argument("--output", required=True, help="table to append to")
    step.add_argument("--lines", action="store_true", help="one object per line")
    step.add_argument("--rejected", help="with --lines: where the bad lines go as text (OUTPUT_rejected)")
    step.add_argument("--format", default="parquet", help="Spark's name of the target's format")
    step.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    step = steps.add_parser("extract")
    step.add_argument("--format", required=True, help="Spark's name of the source's format")
    step.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    step.add_argument("--schema", help="columns and types, else the source is asked")
    step.add_argument("--output", required=True, help="Parquet table to overwrite")

    step = steps.add_parser("preview")
    step.add_argument("--input", required=True, help="JSON, one object per line")
    step.add_argument("--rows", type=int, default=5)

    step = steps.add_parser("score", parents=[scoring, keyed])
    step.add_argument("--input", required=True, help="Parquet reviews")
    step.add_argument("--output", required=True, help="root of the scored runs")

    step = steps.add_parser("prepare", parents=[preparing, keyed])
    step.add_argument("--input", required=True, help="root of the scored runs")
    step.add_argument("--output", required=True)

    step = steps.add_parser("train", parents=[training])
    step.add_argument("--train", required=True)
    step.add_argument("--validation", required=True)
    step.add_argument("--model_output", default="purchase_model")
    step.add_argument("--features", help="fitted features of the prepare step, saved with the trees")

    step = steps.add_parser("predict", parents=[scoring, keyed])
    step.add_argument("--input", required=True, help="Parquet reviews")
    step.add_argument("--model", required=True, help="what train or run has saved")
    step.add_argument("--output", required=True)

    step = steps.add_parser("run", parents=[scoring, preparing, training, keyed])
    step.add_argument("--input", required=True, help="Parquet reviews")
    step.add_argument("--output", required=True)
    return top


def _options(args) -> dict:
    return dict(option.split("=", 1) for option in args.option)


def _scoring(args) -> dict:
    """The arguments of ``score_run`` and ``run`` that concern the scorer."""
    return {
        "scorer": _scorer(args),
        "partitions": args.partitions,
        "make_client": imported(args.client) if args.client else None,
        "max_chars": args.max_chars,
        "key": args.key,
        "max_error_share": args.max_error_share,
    }


def _write_rejected(spark, args, staged: str | None) -> None:
    """The bad lines of all loads into a Parquet table, or of this one into another format, as text."""
    if args.format == "parquet":
        bad = read_rejected(spark, args.output).select("line")
    elif staged:
        bad = spark.read.parquet(staged).select("line")
    else:
        return
    out = args.rejected or args.output.rstrip("/") + "_rejected"
    bad.write.mode("overwrite").text(out)


def _predict(spark, args) -> str:
    reviews = read_reviews(spark, args.input)
    model = load_purchase_model(spark, args.model)
    if args.client and model.others_only:
        # Predictions look at a review's own scores: ask once, read from the run.
        options = {k: v for k, v in _scoring(args).items() if k != "scorer"}
        run = score_run(spark, args.input, f"{args.output}_scored", resume=args.resume, **options)
        reviews = spark.read.parquet(run)
    keep = [args.key] if args.key else [c for c in reviews.columns if c not in (TEXT, SENTIMENT)]
    return write_parquet(predict(model, reviews, keep, _scorer(args)), args.output)


def main(argv=None) -> dict:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"purchase_signals {args.step}").getOrCreate()
    if getattr(args, "format", None) == FORMAT:
        register(spark)
    try:
        result = _do(spark, args)
    finally:
        # Results are written to the paths given.
        remove_intermediates(spark)
    print(json.dumps(result))
    return result


def _do(spark: SparkSession, args) -> dict:
    """The step that ``args`` name; returns what is printed."""
    if args.step == "sample":
        first = None if args.all else args.first
        path = sample_json(spark, args.input, args.output, first, args.rows, args.seed)
        result = {"sample": path}
    elif args.step == "load":
        loaded = load_json(
            spark, args.input, args.output, lines=args.lines, fmt=args.format, options=_options(args)
        )
        result = loaded if args.lines else {"inserted": loaded}
        if args.lines:
            _write_rejected(spark, args, result.pop("rejected_lines", None))
        result = {k: v for k, v in result.items() if v or k in ("inserted", "rejected")}
    elif args.step == "extract":
        extract_to_lake(spark, args.format, _options(args), args.output, schema=args.schema)
        result = {"extracted": args.output}
    elif args.step == "preview":
        result = preview_lines(spark, args.input, args.rows)
    elif args.step == "score":
        result = {}
        result["scored"] = score_run(
            spark, args.input, args.output, report=result, resume=args.resume, **_scoring(args)
        )
    elif args.step == "prepare":
        scored = read_latest_run(spark, args.input)
        options = (not args.no_one_hot, args.others_only, args.on_unscored)
        train, validation = prepare(scored, args.output, args.key, *options, game_as=args.game_as)
        result = {"train": train, "validation": validation}
        result["features"] = f"{args.output}/{FEATURES_FOLDER}"
    elif args.step == "train":
        trees = train_gbt(spark.read.parquet(args.train), args.max_iter)
        result = evaluate(trees, spark.read.parquet(args.validation))
        if args.features:
            model = load_purchase_model(spark, args.features).with_trees(trees)
            result["model"] = save_purchase_model(model, args.model_output)
        else:
            result["model"] = save_model(trees, args.model_output)
    elif args.step == "predict":
        result = {"predictions": _predict(spark, args)}
    else:
        result = run(
            spark,
            args.input,
            args.output,
            max_iter=args.max_iter,
            one_hot=not args.no_one_hot,
            others_only=args.others_only,
            on_unscored=args.on_unscored,
            game_as=args.game_as,
            take_over=args.resume,
            **_scoring(args),
        )
    return result


if __name__ == "__main__":
    main()
