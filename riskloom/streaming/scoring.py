"""Scoring a stream of feature rows into the decision log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom import schemas as S
from riskloom.operators.decisions import decision_records
from riskloom.sources.sinks import append_batch
from riskloom.sources.tables import parse_feature_rows
from riskloom.streaming.rollup import write_summary

def is_valid() -> Column:
    """Whether a parsed row can be scored: every field present, the instant readable, flags 0/1."""
    present = [F.col(c).isNotNull() for c in S.FEATURE_COLUMNS if c != "timestamp"]
    readable = F.col("timestamp").try_cast("timestamp_ntz").isNotNull()
    flags = [F.col(c).isin(0, 1) for c in S.FLAG_COLUMNS]
    valid = readable
    for check in present + flags:
        valid = valid & check
    return F.coalesce(valid, F.lit(False))


def typed(rows: DataFrame) -> DataFrame:
    """Wire rows to the feature schema."""
    return rows.select(*[
        F.col(f.name).try_cast(f.dataType).alias(f.name) for f in S.FEATURES
    ])


def next_id(spark: SparkSession, log_path: str, stream: str, batch_id: int) -> int:
    """The id that follows those of everything logged before this batch.

    The batch before it in the same stream tells; the whole log is asked only by the first
    batch of a stream, or after a batch without records. What an earlier attempt at this very
    batch has written does not count.
    """
    def written(folder: str) -> bool:
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
        return bool(files.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files))

    before = f"{log_path}/stream={stream}/batch_id={batch_id - 1}"
    if batch_id > 0 and written(before):
        largest = spark.read.parquet(before).agg(F.max("id")).first()[0]
        if largest is not None:
            return largest + 1
    if not written(f"{log_path}/stream=*/batch_id=*"):
        return 0
    earlier = spark.read.parquet(log_path).where(
        (F.col("stream") != stream) | (F.col("batch_id") < batch_id))
    largest = earlier.agg(F.max("id")).first()[0]
    return 0 if largest is None else largest + 1


def with_ids(rows: DataFrame, first_id: int) -> DataFrame:
    """Add ``id``: rows numbered from ``first_id`` without a gap, partition by partition."""
    marked = rows.withColumn("__raw", F.monotonically_increasing_id())
    partition = F.shiftright("__raw", 33)
    sizes = marked.groupBy(partition.alias("__partition")).agg(F.count("*").alias("__n"))
    # One row per partition of the batch.
    earlier = W.orderBy("__partition").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("__partition", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    place = F.col("__raw").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.withColumn("__partition", partition).join(
        F.broadcast(starts), "__partition").select(
        *rows.columns, (F.lit(first_id) + F.col("__start") + place).cast("bigint").alias("id"))


def score_batch(rows: DataFrame, scorer: Callable[[DataFrame], DataFrame], t_review: float,
                t_block: float, model_run_id: str, first_id: int,
                created_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(decision records, rejected rows) of one batch of wire rows. Nothing is collected.

    ``scorer`` adds ``model_score`` (and optionally ``shap_top_features``) to feature rows.
    """
    checked = rows.withColumn("__valid", is_valid())
    good = typed(checked.where("__valid"))
    scored = scorer(with_ids(good, first_id)).withColumn(
        "created_at", created_at if created_at is not None else F.current_timestamp())
    top = F.col("shap_top_features") if "shap_top_features" in scored.columns else None
    records = decision_records(scored, t_review, t_block, model_run_id, top_features=top,
                               carried=["id", "created_at"])
    rejected = checked.where(~F.col("__valid")).drop("__valid")
    return records, rejected


def score_stream(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame], t_review: float,
                 t_block: float, model_run_id: str, log_path: str, rejected_path: str,
                 checkpoint_path: str, summary_path: str | None = None) -> StreamingQuery:
    """Drain what the source holds, append decisions to the log, stop.

    With ``summary_path`` every batch also leaves its counts per minute and outcome there.

    A row that cannot be scored goes to ``rejected_path`` and does not stop the batch. Any
    other error fails the batch, which the next start repeats from the checkpoint; each
    batch writes its own partition, so a repeated batch replaces its earlier rows. A log has
    one live stream at a time; a stream with a new checkpoint continues its ids.
    """
    def process(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        first_id = next_id(spark, log_path, stream, batch_id)
        rows.persist()  # two tables are written, the source is read once
        try:
            records, rejected = score_batch(rows, scorer, t_review, t_block, model_run_id, first_id)
            append_batch(records, log_path, stream, batch_id)
            if summary_path:
                # Read off what was just written, so that both say the same.
                write_summary(spark.read.parquet(f"{log_path}/stream={stream}/batch_id={batch_id}"),
                              summary_path, stream, batch_id)
            append_batch(rejected, rejected_path, stream, batch_id)
        finally:
            rows.unpersist()

    return (
        parse_feature_rows(messages).writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(process)
        .start()
    )


def batch_counts(log: DataFrame, rejected: DataFrame) -> DataFrame:
    """Scored and skipped rows of every batch, read off the two written tables."""
    batch = ["stream", "batch_id"]
    scored = log.groupBy(*batch).agg(F.count("*").alias("scored"))
    skipped = rejected.groupBy(*batch).agg(F.count("*").alias("skipped"))
    return scored.join(skipped, batch, "full_outer").fillna(0, ["scored", "skipped"])
