"""Writers: Parquet tables, CSV, JSON documents and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.tables import kafka_options

#: Rows of a document that holds one JSON array.
ROWS_PER_ARRAY = 10_000


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; a one-row frame becomes a single document."""
    df.write.mode("overwrite").json(path)


def write_json_arrays(rows: DataFrame, path: str, key: str, size: int = ROWS_PER_ARRAY) -> None:
    """Documents that hold one JSON array each, of about ``size`` rows by a hash of ``key``.

    Every document is a file of its own, so that tasks share both the writing and a reading
    with ``multiLine``. ``rows`` are read twice.
    """
    documents = max(1, -(-rows.count() // size))
    arrays = rows.groupBy(F.pmod(F.xxhash64(key), F.lit(documents)).alias("_document")).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct(*rows.columns)))).alias("value"))
    arrays.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def as_message() -> Column:
    """The whole row as one JSON message. Absent fields stay visible as nulls."""
    return F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")


def publish_files(rows: DataFrame, path: str, files: int | None = None, file_rows: int = 0,
                  compression: str = "none") -> None:
    """Publish rows as JSON lines into a folder a file stream can follow.

    The write commits as a whole, so nothing counts as sent unless all of it was. ``files`` spreads
    the messages evenly, which moves and sorts them all; with ``file_rows`` every task writes what
    it holds, in files of at most that many rows.
    """
    messages = rows.select(as_message())
    if files:
        messages = messages.repartition(files)
    messages.write.mode("append").option("maxRecordsPerFile", file_rows).option("compression", compression).text(path)


def publish_kafka(rows: DataFrame, servers: str, topic: str,
                  certificates: dict[str, str] | None = None) -> None:
    """Publish rows to a topic; the job fails unless the broker acknowledged every one."""
    (
        rows.select(as_message()).write.format("kafka")
        .options(**kafka_options(servers, certificates))
        .option("topic", topic).option("kafka.acks", "all")
        .save()
    )


def append_batch(rows: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """Append one micro-batch of a stream to a table, in its own partition.

    A batch that is replayed overwrites its own partition, so a retry after a crash
    leaves the table unchanged instead of adding the rows again. A stream that starts over
    with a new checkpoint has a new id and so leaves earlier rows alone.
    """
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/stream={stream}/batch_id={batch_id}")
