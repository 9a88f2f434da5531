"""Jobs over entity tables stored as Parquet; submit with spark-submit or ``python -m riskloom``.

    features    --data-dir D [--output-dir D]
    train       --data-dir D --model-dir M [--rounds N] [--trees N]
    thresholds  --data-dir D --model-dir M --output P --run-id R
    stream      --data-dir D --model-dir M --thresholds P --run-id R --log L --rejected R
                --checkpoint C (--topic-dir T | --kafka SERVERS --topic NAME)
    check-log   --log L [--limit N]          exit status 1 when a check fails
    drift       --data-dir D --log L [--limit N] [--mode auto|p_value|distance]
    compact     --store S [--file-rows N]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import drift, drift_tests, features, quality, splits
from riskloom.operators.model import BOOSTING_ROUNDS, TREES, CalibratedModel
from riskloom.plans import training
from riskloom.session import durable, prepare, release_copies
from riskloom.sources import sinks, tables
from riskloom.sources.log_store import FILE_ROWS, LogStore
from riskloom.streaming import scoring


def _matrix(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = splits.labelled_rows(tables.read_entity(spark, data_dir, "features"),
                                tables.read_entity(spark, data_dir, "ground_truth"))
    return splits.model_matrix(splits.with_split(rows),
                               keep=["transaction_id", "fraud_label", "split"])


def build_features(spark: SparkSession, a: argparse.Namespace) -> None:
    built = durable(features.feature_table(*(
        tables.read_entity(spark, a.data_dir, n)
        for n in ("transactions", "customers", "devices", "ground_truth"))))
    quality.require_valid(built, "features")
    path = f"{a.output_dir or a.data_dir}/features.parquet"
    sinks.write_parquet(built, path)
    print(f"wrote {built.count()} rows to {path}")


def train(spark: SparkSession, a: argparse.Namespace) -> None:
    run = training.run(_matrix(spark, a.data_dir), rounds=a.rounds, trees=a.trees)
    run.deployed.save(a.model_dir)
    training.enrich(a.model_dir, run.matrix)
    report = f"{a.model_dir}/report"
    sinks.write_json(run.validation_metrics, f"{report}/validation")
    sinks.write_json(run.test_metrics, f"{report}/test")
    sinks.write_json(run.baseline_test_metrics, f"{report}/baseline_test")
    sinks.write_json(run.calibration_curve, f"{report}/calibration_curve")
    sinks.write_json(run.importances, f"{report}/importances")
    sinks.write_json(run.row_counts, f"{report}/row_counts")
    sinks.write_csv(run.anomaly_scores, f"{report}/anomaly_scores")
    sinks.write_csv(run.background.select(*run.inputs), f"{report}/background")
    print(f"deployed {run.deployed_name}, best boosted {run.champion_name}")


def thresholds(spark: SparkSession, a: argparse.Namespace) -> None:
    amounts = tables.read_entity(spark, a.data_dir, "features").select("transaction_id", "amount")
    document = training.choose_policy(a.model_dir, _matrix(spark, a.data_dir), amounts, a.run_id)
    sinks.write_json(document, a.output)


def stream(spark: SparkSession, a: argparse.Namespace) -> None:
    chosen = spark.read.schema("t_review double, t_block double, model_run_id string").json(
        a.thresholds).first()
    if chosen["model_run_id"] != a.run_id:
        print(f"warning: thresholds belong to run {chosen['model_run_id']}, not {a.run_id}",
              file=sys.stderr)
    matrix = _matrix(spark, a.data_dir)
    inputs = training.inputs_of(matrix)
    # Only the means of the train split matter, so one row stands for it.
    background = durable(matrix.where("split = 'train'").agg(
        *[F.avg(c).alias(c) for c in inputs]))
    scorer = training.model_scorer(CalibratedModel.load(a.model_dir), inputs, background)
    messages = (tables.read_kafka_stream(spark, a.kafka, a.topic) if a.kafka
                else tables.read_file_stream(spark, a.topic_dir))
    scoring.score_stream(messages, scorer, chosen["t_review"], chosen["t_block"], a.run_id, a.log,
                         a.rejected, a.checkpoint).awaitTermination()


def check_log(spark: SparkSession, a: argparse.Namespace) -> None:
    log = spark.read.parquet(a.log)
    summary = quality.scored_summary(log, a.limit).first()
    print(f"checked {summary['checked_rows']} rows: {'passed' if summary['passed'] else 'FAILED'}")
    if not summary["passed"]:
        recent = quality.newest_payloads(log, a.limit)
        for r in quality.column_checks(recent, quality.expectations("features")).where(
                "failures > 0").collect():  # at most one line per check
            print(f"  {r['column']}: {r['check']} failed {r['failures']} times")
        raise SystemExit(1)


def drift_report(spark: SparkSession, a: argparse.Namespace) -> None:
    reference = tables.read_entity(spark, a.data_dir, "features")
    current = quality.newest_payloads(spark.read.parquet(a.log), a.limit)
    report = drift.drift_report(reference, current)
    report.orderBy(F.desc("distance")).show(truncate=False)
    drift.drift_summary(report, current).show()
    tests = durable(drift_tests.column_tests(reference, current, mode=a.mode))
    tests.orderBy("column").show(truncate=False)
    drift_tests.tests_summary(tests, current).show()


def compact(spark: SparkSession, a: argparse.Namespace) -> None:
    store = LogStore(spark, a.store, a.file_rows)
    done = store.compact()
    print(f"generation {store.generation()}{'' if done else ', nothing new'}")


JOBS = {"features": build_features, "train": train, "thresholds": thresholds, "stream": stream,
        "check-log": check_log, "drift": drift_report, "compact": compact}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="riskloom")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str, **defaults) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        for r in required:
            p.add_argument(f"--{r}", required=True)
        for k, v in defaults.items():
            p.add_argument(f"--{k.replace('_', '-')}", default=v,
                           type=int if isinstance(v, int) else str)
        return p

    job("features", "data-dir", output_dir=None)
    job("train", "data-dir", "model-dir", rounds=BOOSTING_ROUNDS, trees=TREES)
    job("thresholds", "data-dir", "model-dir", "output", "run-id")
    job("stream", "data-dir", "model-dir", "thresholds", "run-id", "log", "rejected",
        "checkpoint", topic_dir=None, kafka=None, topic="transactions")
    job("check-log", "log", limit=500)
    job("drift", "data-dir", "log", limit=500, mode="auto")
    job("compact", "store", file_rows=FILE_ROWS)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    session = prepare(spark or SparkSession.builder.appName("riskloom").getOrCreate())
    try:
        JOBS[a.job](session, a)
    finally:
        if spark is None:  # a job of its own: nothing reads its intermediate copies any more
            release_copies(session)


if __name__ == "__main__":
    main()
