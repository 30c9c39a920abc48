"""Command line: ``python -m vidpulse <step> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation

from vidpulse.operators.cleaning import clean_logs, normalize_columns, with_defaults
from vidpulse.operators.sampling import generate_logs, inject_trend
from vidpulse.plans.batch import BatchSettings, run_from_table
from vidpulse.session import build_session
from vidpulse.sources.sinks import publish, write_topic
from vidpulse.sources.tables import read_csv_text, read_table, replay
from vidpulse.sources.topic import peek_topic, read_topic_batch, to_messages
from vidpulse.streaming.medallion import run_bronze, run_silver


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vidpulse")
    top.add_argument("--master", default=None)
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, *positional: str, **options) -> None:
        sub = steps.add_parser(name)
        for p in positional:
            sub.add_argument(p)
        for o, default in options.items():
            sub.add_argument(f"--{o.replace('_', '-')}", default=default, type=type(default))

    step("clean-csv", "source", "target")
    step("generate", "target", rows=100_000, seed=42)
    step("produce", "source", "topic", servers="localhost:9092", fmt="kafka", limit=0)
    step("peek", "topic", servers="localhost:9092", fmt="kafka", n=10)
    step("bronze", "topic", "target", "checkpoint", servers="localhost:9092", topic_fmt="kafka", fmt="parquet")
    step("silver", "bronze", "target", "checkpoint", fmt="parquet")
    step("batch", "silver", "out_dir", window="30 minutes", scaling="max", threshold="exact", fmt="parquet")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("vidpulse", args.master)
    if args.step == "clean-csv":
        raw = with_defaults(normalize_columns(read_csv_text(spark, args.source)))
        print(publish(clean_logs(raw, "clamp"), args.target))
    elif args.step == "generate":
        logs = generate_logs(spark.range(args.rows), seed=args.seed)
        print(publish(inject_trend(logs, seed=args.seed, ordered=False), args.target))
    elif args.step == "produce":
        logs = read_table(spark, args.source)
        if args.limit:
            order = ["event_time", "event_id"] if "event_id" in logs.columns else ["event_time"]
            logs = replay(logs, args.limit, order)
        rejects = Observation()
        print(write_topic(to_messages(logs, rejects=rejects), args.topic, args.servers, args.fmt, rejects))
    elif args.step == "peek":
        peek_topic(read_topic_batch(spark, args.topic, args.servers, args.fmt), args.n).show(args.n, False)
    elif args.step == "bronze":
        print(
            run_bronze(
                spark, args.topic, args.target, args.checkpoint,
                servers=args.servers, topic_fmt=args.topic_fmt, fmt=args.fmt,
            )
        )
    elif args.step == "silver":
        print(run_silver(spark, args.bronze, args.target, args.checkpoint, fmt=args.fmt))
        read_table(spark, args.target, args.fmt).show(5, False)
    elif args.step == "batch":
        threshold = args.threshold if args.threshold in ("exact", "approx") else float(args.threshold)
        settings = BatchSettings(window=args.window, scaling=args.scaling, threshold=threshold)
        reports, summary = run_from_table(spark, args.silver, args.out_dir, settings, args.fmt)
        for name, report in reports.items():
            print(name, report)
        summary.show(100, False)


if __name__ == "__main__":
    main()
