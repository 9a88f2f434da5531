"""Readers: Parquet, JSON, CSV, JDBC tables and Kafka topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schemas import ENTITIES, FEATURE_WIRE


def read_entity(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """An entity table by name, read with its declared schema."""
    return spark.read.schema(ENTITIES[name]).parquet(f"{data_dir}/{name}.parquet")


def read_json_pool(spark: SparkSession, path: str,
                   schema: T.StructType = FEATURE_WIRE) -> DataFrame:
    """A file (or folder of files) each holding one JSON array of rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None,
              bounds: tuple[int, int] | None = None, partitions: int = 1,
              **options: str) -> DataFrame:
    """A relational table; with ``key`` and ``bounds`` it is read by parallel key ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key and bounds:
        reader = (reader.option("partitionColumn", key).option("lowerBound", bounds[0])
                  .option("upperBound", bounds[1]).option("numPartitions", partitions))
    return reader.options(**options).load()


def kafka_options(servers: str, certificates: dict[str, str] | None = None) -> dict[str, str]:
    """Connection options; ``certificates`` maps ``kafka.ssl.*`` names to their values."""
    options = {"kafka.bootstrap.servers": servers}
    if certificates:
        options |= {"kafka.security.protocol": "SSL", **certificates}
    return options


def read_kafka_stream(spark: SparkSession, servers: str, topic: str,
                      certificates: dict[str, str] | None = None,
                      rows_per_batch: int = 1_000_000) -> DataFrame:
    """A topic from its earliest offset, as a stream with a ``value`` column.

    ``rows_per_batch`` bounds a batch, so that draining a large topic takes many of them.
    Needs the Kafka connector package that matches the running Spark.
    """
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, certificates))
        .option("subscribe", topic).option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", rows_per_batch).load()
    )


def read_file_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same shape from a folder of text files holding one JSON object per line."""
    return (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch)
        .text(path)
    )


def parse_feature_rows(messages: DataFrame) -> DataFrame:
    """JSON messages to typed rows; a field that does not fit becomes null."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), FEATURE_WIRE).alias("row")
    ).select("row.*")
