"""Command line: one subcommand per job, for ``python -m plaudit`` or ``spark-submit``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plaudit.operators.anomaly import detect, flag_summary
from plaudit.operators.classify import train_classifier
from plaudit.operators.documents import search_documents, upsert_documents
from plaudit.operators.quality import REVIEWS_SUITE, load_suite, summarise, validate
from plaudit.operators.similar import similar_reviews
from plaudit.operators.topics import fit_topics
from plaudit.plans.batch import run_batch
from plaudit.plans.increments import export_gold, read_silver_version, refresh_gold, refresh_silver
from plaudit.plans.warehouse import load_warehouse
from plaudit.session import build_session
from plaudit.sources.connectors import kafka_sink, kafka_source, publish, read_stream
from plaudit.sources.lake import Lake, land_csv, read_csv, read_labelled, write_csv, write_report
from plaudit.storage import materialise
from plaudit.streaming.jobs import start_scoring
from plaudit.streaming.messages import to_messages


def run_land(spark: SparkSession, args) -> int:
    print(land_csv(spark, Lake(args.lake), args.source))
    return 0


def run_silver(spark: SparkSession, args) -> int:
    counts = refresh_silver(spark, Lake(args.lake)).counts
    print(f"silver: {counts['silver']} rows from {counts['raw']}")
    return 0


def run_gold(spark: SparkSession, args) -> int:
    lake = Lake(args.lake)
    refresh_gold(spark, lake)
    print("\n".join(export_gold(spark, lake)))
    return 0


def run_check(spark: SparkSession, args) -> int:
    """Exit code 1 when a check fails."""
    df = read_csv(spark, args.source) if args.source else read_silver_version(spark, Lake(args.lake))
    suite = load_suite(args.suite) if args.suite else REVIEWS_SUITE
    report = materialise(validate(df, suite), "report")
    if args.report:
        write_report(report, args.report)
    for row in report.collect():
        print(f"{'pass' if row['success'] else 'FAIL'}  {row['name']}: {row['unexpected']} of {row['total']}")
    summary = summarise(report, suite).first()
    print(f"{summary['suite']}: {summary['checks_passed']} of {summary['checks_total']} checks passed")
    return 0 if summary["success"] else 1


def run_detect(spark: SparkSession, args) -> int:
    flagged = materialise(detect(read_csv(spark, args.source)), "flagged")
    write_csv(flagged.filter("is_suspicious"), args.out)
    print(flag_summary(flagged).first().asDict())
    return 0


def run_topics(spark: SparkSession, args) -> int:
    topics = fit_topics(read_csv(spark, args.source), k=args.k)
    write_csv(topics.labelled, args.out)
    sizes = {row["topic_cluster"]: row["rows"] for row in topics.sizes().collect()}
    for row in topics.terms.orderBy("cluster").collect():
        print(f"{row['cluster']} ({sizes.get(row['cluster'], 0)}): {', '.join(row['terms'])}")
    return 0


def run_warehouse(spark: SparkSession, args) -> int:
    name = args.load or datetime.now(timezone.utc).strftime("load-%Y%m%dT%H%M%S%f")
    star = load_warehouse(read_silver_version(spark, Lake(args.lake)), args.warehouse, name)
    print(f"{name}: {star.fact_reviews.count()} facts")
    return 0


def run_chain(spark: SparkSession, args) -> int:
    result = run_batch(spark, Lake(args.lake), args.source, args.warehouse)
    print(result.counts, result.marts)
    return 0


def run_publish(spark: SparkSession, args) -> int:
    publish(to_messages(read_csv(spark, args.source)), kafka_sink(args.servers, args.topic))
    return 0


def run_stream(spark: SparkSession, args) -> int:
    source = read_stream(spark, kafka_source(args.servers, args.topic, args.starting))
    start_scoring(source, args.checkpoint, options=kafka_sink(args.servers, args.scored)).awaitTermination()
    return 0


def run_train(spark: SparkSession, args) -> int:
    def texts(path: str):
        return read_labelled(spark, path).withColumn("text_id", F.md5(F.col("text").cast("binary")))

    model = train_classifier(texts(args.train), texts(args.test), "text_id")
    model.save(args.out)
    print(f"accuracy {model.accuracy:.4f}")
    return 0


def run_index(spark: SparkSession, args) -> int:
    """Writes a new search table: the previous one with the documents of this file put in."""
    documents = search_documents(read_csv(spark, args.source), with_vector=not args.no_vector, keep=(args.order,))
    base = spark.read.parquet(args.previous) if args.previous else documents.drop(args.order).limit(0)
    upsert_documents(base, documents, (args.order,)).write.mode("errorifexists").parquet(args.out)
    return 0


def run_similar(spark: SparkSession, args) -> int:
    """The reviews most like those of another file, as CSV."""
    found = similar_reviews(read_csv(spark, args.source), read_csv(spark, args.wanted), args.k, exact=args.exact)
    write_csv(found, args.out)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="plaudit", description=__doc__)
    top.add_argument("--master", help="Spark master; by default the one spark-submit sets")
    commands = top.add_subparsers(required=True)

    def command(name: str, run, *required: str, **optional):
        sub = commands.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            flag = f"--{option.replace('_', '-')}"
            if default is False:
                sub.add_argument(flag, action="store_true")
            else:
                sub.add_argument(flag, default=default, type=type(default) if default is not None else str)

    command("land", run_land, "source", "lake")
    command("silver", run_silver, "lake")
    command("gold", run_gold, "lake")
    command("check", run_check, source=None, lake=None, suite=None, report=None)
    command("detect", run_detect, "source", "out")
    command("topics", run_topics, "source", "out", k=6)
    command("warehouse", run_warehouse, "lake", "warehouse", load=None)
    command("batch", run_chain, "source", "lake", "warehouse")
    command("publish", run_publish, "source", "servers", topic="reviews.raw")
    command("stream", run_stream, "servers", "checkpoint", topic="reviews.raw", scored="reviews.scored",
            starting="latest")
    command("train", run_train, "train", "test", "out")
    command("index", run_index, "source", "out", previous=None, order="review_date", no_vector=False)
    command("similar", run_similar, "source", "wanted", "out", k=10, exact=False)
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.run is run_check and not (args.source or args.lake):
        parser().error("check needs --source or --lake")
    return args.run(build_session("plaudit", args.master), args)
