"""Exact dedup by content sort.

Rows are range-partitioned by a bounded prefix of their bytes and a hash of the whole
(splitters are sampled from these short keys, never from whole texts), sorted externally
inside each partition with the whole text as the last sort key, and compared with their
neighbours in full. Equal texts share the range keys, so they meet in one partition.

A text with more copies than a task should hold (``hot_rows``, or a quarter of an even
partition, whichever is more) gets a salt from the identifier as a further range key. Its
copies then lie in up to ``salts`` runs in different partitions; the heads of these runs, a
bounded number, are compared and combined afterwards. Nothing but DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import shuffle_partitions, table
from riskloom.session import durable


def _groups(docs: DataFrame, text: str, key: str, keep: str, carry: list[str], prefix_bytes: int,
            hot_rows: int, salts: int) -> DataFrame:
    """``row`` (a struct of the carried columns) and the four columns of the result."""
    spark = docs.sparkSession
    largest = keep == "largest"
    best = F.max if largest else F.min
    whole = F.coalesce(F.col(text), F.lit(""))
    # The text travels once: it is put back into the row from the sort key.
    others = [F.col(c) for c in carry if c != text]
    rows = docs.select(
        F.struct(F.lit(1).alias("_"), *others).alias("_row"), F.col(key).alias("_id"), whole.alias("_text"),
        F.col(text).isNull().alias("_missing"), F.xxhash64(whole).alias("_hash"))

    # Hashes of texts with very many copies: at most four for each partition.
    limit = max(hot_rows, docs.count() // (4 * shuffle_partitions(spark)))
    hot = durable(rows.groupBy("_hash").agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
                  .select("_hash", F.lit(True).alias("_hot")))
    any_hot = not hot.isEmpty()
    near = ["_prefix", "_hash"]
    if any_hot:
        near += ["_salt"]
        rows = rows.join(F.broadcast(hot), "_hash", "left").withColumn(
            "_salt", F.when(F.col("_hot"), F.pmod(F.hash("_id"), F.lit(salts))).otherwise(0))

    ranged = rows.withColumn(
        "_prefix", F.substring(F.col("_text").cast("binary"), 1, prefix_bytes)).repartitionByRange(*near)
    same = Window.partitionBy(*near, "_text")
    first = same.orderBy(F.col("_id").desc_nulls_last() if largest else F.col("_id").asc_nulls_last())
    everyone = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = ranged.withColumns({
        "text_sha256": F.sha2("_text", 256), "keep_id": F.first("_id").over(first),
        "_rank": F.row_number().over(first), "group_size": F.count("*").over(everyone)})
    if text in carry:
        runs = runs.withColumn("_whole", F.when(~F.col("_missing"), F.col("_text")))
    if any_hot:
        head = F.col("_hot") & (F.col("_rank") == 1)
        runs = durable(runs.withColumn("_text", F.when(head, F.col("_text"))).drop("_prefix"))
        heads = runs.where("_hot and _rank = 1")
        totals = heads.groupBy("text_sha256", "_text").agg(
            best("keep_id").alias("_keep"), F.sum("group_size").alias("_size"))
        # At most `salts` runs of each hot text.
        merged = heads.select("text_sha256", "_text", "_salt").join(totals, ["text_sha256", "_text"]).drop("_text")
        runs = runs.join(F.broadcast(merged), ["text_sha256", "_salt"], "left").withColumn(
            "_rank", F.when(F.col("_keep").isNull() | F.col("keep_id").eqNullSafe(F.col("_keep")), F.col("_rank"))
        ).withColumn("keep_id", F.coalesce("_keep", "keep_id")).withColumn(
            "group_size", F.coalesce("_size", "group_size"))
    row = F.struct(*[F.col("_whole").alias(c) if c == text else F.col("_row")[c].alias(c) for c in carry])
    return runs.select(
        row.alias("row"), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.coalesce(F.col("_rank") == 1, F.lit(False)).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "largest",
                carry: list[str] | None = None, prefix_bytes: int = 32, hot_rows: int = 1000,
                salts: int = 64) -> DataFrame:
    """Group rows with identical text.

    Returns the columns ``carry`` (default: the identifier) of every row with ``keep_id``
    (the largest or smallest identifier of its group), ``group_size``, ``kept`` and
    ``text_sha256``. A null text counts as empty; texts are compared byte by byte without
    any change. Exactly one row of a group is kept: rows that repeat the identifier tie, and
    one of them stays. A null identifier loses against any other; a group of nulls only
    has a null ``keep_id``. An empty table gives an empty result. Other columns of ``docs``
    are ignored unless carried, whatever their names.
    """
    found = _groups(docs, text, key, keep, carry or [key], prefix_bytes, hot_rows, salts)
    return found.select("row.*", "keep_id", "group_size", "kept", "text_sha256")


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def stage(spark, docs, sf_dir):
    """Pipeline stage: one document of each group of equal texts stays, its columns as they were."""
    return _groups(docs, "text", "doc_id", "largest", docs.columns, 32, 1000, 64).where("kept").select("row.*")
