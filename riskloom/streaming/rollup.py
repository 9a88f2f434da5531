"""Monitoring figures kept up to date: the log per minute and outcome, batch by batch.

Every batch of the log writes its own small summary under its own batch id, so repeating a
batch replaces its summary as it replaces its rows. Summaries add up: reading them gives the
figures of the whole log without opening it. A time limit inside a minute is the one thing a
summary can't answer; that single minute is counted in the log itself.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import minute_key
from riskloom.schemas import DECISIONS
from riskloom.sources.sinks import append_batch


def summary(records: DataFrame) -> DataFrame:
    """One row per minute and outcome: rows, rows with a score, and the sum of their scores."""
    return records.groupBy(F.date_trunc("minute", "created_at").cast("timestamp_ntz").alias("minute"), "decision").agg(
        F.count("*").alias("rows"), F.count("model_score").alias("scored"), F.sum("model_score").alias("score"))


def write_summary(records: DataFrame, path: str, stream: str, batch_id: int) -> None:
    # One row per minute and outcome of a batch: a single small file.
    append_batch(summary(records).coalesce(1), path, stream, batch_id)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summaries of all batches, added up."""
    return spark.read.parquet(path).groupBy("minute", "decision").agg(
        *[F.sum(c).alias(c) for c in ("rows", "scored", "score")])


def _cutoff(as_of: dt.datetime | str, minutes: int) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def since(parts: DataFrame, log: DataFrame, as_of: dt.datetime | str, minutes: int) -> DataFrame:
    """The summary of what is not older than ``minutes`` before ``as_of``: whole minutes from the
    summaries, and the minute the limit falls into from the log."""
    cutoff = _cutoff(as_of, minutes)
    first = F.date_trunc("minute", cutoff).cast("timestamp_ntz")
    next_minute = first + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    edge = log.where((F.col("created_at") >= cutoff) & (F.col("created_at") < next_minute))
    whole = parts.where(F.col("minute") >= next_minute)
    return whole.unionByName(summary(edge))


def stats(parts: DataFrame) -> DataFrame:
    scored = F.sum("scored")
    return parts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(F.when(F.col("decision") == d, F.col("rows"))), F.lit(0)).alias(f"{d}_count") for d in DECISIONS],
        F.when(scored > 0, F.sum("score") / scored).otherwise(0.0).alias("avg_score"))


def by_minute(parts: DataFrame) -> DataFrame:
    return parts.groupBy(minute_key("minute").alias("minute"), "decision").agg(
        F.sum("rows").alias("count")).orderBy("minute", "decision")


def by_minute_wide(parts: DataFrame) -> DataFrame:
    return parts.groupBy(minute_key("minute").alias("minute")).agg(*[
        F.coalesce(F.sum(F.when(F.col("decision") == d, F.col("rows"))), F.lit(0)).alias(d) for d in DECISIONS
    ]).orderBy("minute")


def kpi_cards(parts: DataFrame, log: DataFrame, as_of: dt.datetime | str, minutes: int = 1440) -> DataFrame:
    """Per outcome: the count over all time and over the last ``minutes``."""
    recent = since(parts, log, as_of, minutes).groupBy("decision").agg(F.sum("rows").alias("recent"))
    every = parts.groupBy("decision").agg(F.sum("rows").alias("all_time"))
    names = parts.sparkSession.createDataFrame([(d,) for d in DECISIONS], "decision string")
    return names.join(every, "decision", "left").join(recent, "decision", "left").select(
        "decision", F.coalesce("all_time", F.lit(0)).alias("all_time"), F.coalesce("recent", F.lit(0)).alias("recent"))


# Counted by a stream over the log

def minute_counts(decisions: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Decisions per minute and outcome on a stream, for update mode.

    A batch gives out the minutes it changed, with their new counts. A minute that the watermark
    has passed leaves the state and can't change any more; decisions that come later than
    ``late`` are dropped and counted in the progress of the query.
    """
    return (
        decisions.withWatermark("created_at", late)
        .groupBy(F.window("created_at", "1 minute").alias("w"), "decision").agg(F.count("*").alias("count"))
        .select(F.date_format("w.start", "yyyy-MM-dd'T'HH:mm").alias("minute"), "decision", "count")
    )


def upsert_counts(path: str, stream: str = "minutes"):
    """A batch writer for ``minute_counts``: a repeated batch replaces what it wrote before."""
    def write(rows: DataFrame, batch_id: int) -> None:
        append_batch(rows, path, stream, batch_id)

    return write


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of every minute and outcome."""
    return spark.read.parquet(path).groupBy("minute", "decision").agg(F.max_by("count", "batch_id").alias("count"))
