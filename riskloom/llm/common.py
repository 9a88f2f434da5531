"""Helpers shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import durable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


#: Rows of an Arrow batch; whole texts are in them, and some are long.
BATCH_ROWS = 500


def bound_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of at most ``BATCH_ROWS`` rows, or what the session says
    if that is less, so that a worker holds a few MB of them at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_to = int(spark.conf.get(name))
    if set_to <= 0 or set_to > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: rows ``(node, root)``.

    ``root`` is the smallest node of the component. Nodes without an edge to another node
    are not returned; nulls and loops are ignored; an empty table gives an empty result.

    Large-star and small-star steps alternate until nothing changes: every step replaces
    links by at most as many links to smaller nodes, so no group is gathered in one task.
    Minima are combined before the shuffle, and the joins that follow can be split by
    adaptive execution where one node has very many links. Each round is written to the
    shared folder, so the loss of an executor repeats one round at most.
    """
    links = (
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("a is not null and b is not null and a <> b").distinct()
    )
    links = durable(links)
    seen = None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        large = (
            both.join(least, "hi").where("lo > hi")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(
            F.explode(F.array(F.struct("hi", F.col("m").alias("lo")),
                              F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")
        ).select("e.hi", "e.lo").where("hi <> lo").distinct()
        links = durable(small)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def most_frequent(counts: DataFrame, size: int) -> list[str]:
    """The most frequent words of ``counts(word, n)``, at most ``size`` of them.

    A histogram of the logarithms of the counts, a few hundred rows, tells from which count on
    words are asked for, so that no more than those come to the driver. Words of the bin that
    no longer fits whole are ordered; words seen once only come in where there is room.
    """
    counts = durable(counts.withColumn("bin", F.floor(F.log2("n") * 16).cast("int")))
    bins = {r["bin"]: r["count"] for r in counts.groupBy("bin").count().collect()}
    total, least, rest = 0, None, None
    for b in sorted(bins, reverse=True):
        if total + bins[b] > size:
            rest = b
            break
        total, least = total + bins[b], b
    words = [] if least is None else [r.word for r in counts.where(F.col("bin") >= least).select("word").collect()]
    if rest is not None and total < size // 2:
        # One bin holds more than half: take a part of it by hash, which is as good as any.
        share = (size - total) / bins[rest]
        some = counts.where((F.col("bin") == rest) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))))
        words += [r.word for r in some.select("word").collect()][:size - total]
    return sorted(words)


def hashed_sample(rows: DataFrame, key: list[str], size: int, surplus: float = 4.0) -> DataFrame:
    """About ``surplus * size`` rows at most, by a hash of the key: what is ordered and cut off
    afterwards stays small however many rows there are."""
    total = rows.count()
    if total <= surplus * size:
        return rows
    share = int(surplus * size / total * (1 << 40))
    return rows.where(F.pmod(F.xxhash64(*key, F.lit(5)), F.lit(1 << 40)) < max(1, share))


def numbered(df: DataFrame, group: list[str], order: list[str], buckets: int, name: str) -> DataFrame:
    """Add ``name``: rows of each ``group`` numbered from 0 without one task per group.

    Rows are numbered inside (group, hash bucket of the order columns); the sizes of those
    buckets, at most ``buckets`` rows a group, are summed up to where each bucket starts.
    ``df`` is read twice, so it should be a stored table.
    """
    salted = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = salted.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    return (
        salted.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, [*group, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_rank"))
        .drop("_bucket", "_start", "_rank")
    )
