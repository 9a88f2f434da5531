"""Session settings the library relies on, and durable materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: UTC rendering of instants, AQE on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cores: str = "*", app: str = "riskloom", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder; a cluster
    session without the setting is an error, since a machine-local path would be
    lost with its executor.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="riskloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


_made: dict[str, list[str]] = {}


def new_shared_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_copies(spark: SparkSession) -> int:
    """Delete the intermediate copies this application has made; returns how many there were.

    For the end of a job: nothing that still reads them may be used afterwards.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def durable(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting its lineage.

    The copy survives the loss of executors, freezes values that depend on physical
    layout, and is columnar, so later readers take only the columns they need. Rows lie in
    a folder for each value of the ``by`` columns, which should have few, so that readers
    who filter on them open only those.
    """
    path = new_shared_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
