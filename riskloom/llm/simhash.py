"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``2 * half`` bits exactly when some value lies within
``half`` bits of both. Every distinct fingerprint therefore emits all values within ``half``
bits of itself, a fixed number of them, and fingerprints meet on such a value after one
shuffle. A meeting point holds at most as many fingerprints as its ball has values, and any
two of them are within ``2 * half`` bits; linking each to the smallest, after checking the
distance, keeps every component without emitting pairs. Rows with equal fingerprints are
collapsed before, so copies never meet.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import bound_batches, components, table
from riskloom.session import durable

_CHUNK = 65536


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of one text, unsigned; zero where it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        n = len(words) - shingle + 1
        if shingle == 3:
            grams = (a + b" " + b + b" " + c for a, b, c in zip(words, words[1:], words[2:]))
        else:
            grams = (b" ".join(words[i:i + shingle]) for i in range(n))
    hashes = np.frombuffer(b"".join([digest(g, seed) for g in grams]), dtype=np.uint8).reshape(n, 8)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _CHUNK):
        # Byte histograms: a byte value's bits count once for each time it occurs.
        part = hashes[i:i + _CHUNK]
        if len(part) < 512:
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        else:
            for j in range(8):
                ones[8 * j:8 * j + 8] += np.bincount(part[:, j], minlength=256) @ _BITS
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def ball(value: Column, half: int) -> Column:
    """All values within ``half`` bits of a long."""
    masks = [0]
    for k in range(1, half + 1):
        for bits in combinations(range(64), k):
            mask = sum(1 << b for b in bits)
            masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return F.array(*[value.bitwiseXOR(F.lit(m).cast("long")) for m in masks])


def links(prints: DataFrame, half: int = 1) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints ``fp`` within ``2 * half`` bits."""
    met = prints.select("fp", F.explode(ball(F.col("fp"), half)).alias("point"))
    least = F.min("fp").over(Window.partitionBy("point"))
    return (
        met.select("fp", least.alias("a")).where("fp <> a").distinct()
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("a"))) <= 2 * half)
        .select("a", F.col("fp").alias("b"))
    )


def simhash_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", half: int = 1,
                   carry: list[str] | None = None) -> DataFrame:
    """Rows with ``fingerprint`` (16 hex digits) and ``component_id``, the smallest identifier
    reachable over links of at most ``2 * half`` differing bits.

    Null and empty texts and texts without a word have fingerprint zero and link like any
    other. Texts shorter than a shingle count as one. Rows that repeat an identifier are all
    returned. Null identifiers take part but never name a component that has others. An
    empty table gives an empty result; other columns are ignored unless carried.
    """
    bound_batches(docs.sparkSession)
    carry = carry or [key]
    rows = durable(docs.select(
        F.struct(*carry).alias("_row"), F.col(key).alias("_id"), _fingerprints(F.col(text)).alias("fp")))
    classes = durable(rows.groupBy("fp").agg(F.min("_id").alias("least")))
    roots = durable(components(links(classes.select("fp"), half)).withColumnRenamed("node", "fp"))
    linked = roots.join(classes, "fp")
    names = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = linked.join(names, "root").select("fp", "component")
    # Stored, so that both sides of the last join are plain tables: a fingerprint of very many
    # rows is then split over tasks.
    classes = durable(classes.join(named, "fp", "left").select(
        "fp", F.coalesce("component", "least").alias("component_id")))
    return rows.join(classes, "fp").select(
        "_row.*", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_simhash_near_dedup(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


def stage(spark, docs, sf_dir):
    """Pipeline stage: of each component the document with the smallest identifier stays.

    Texts stay where they are: the others are found by identifier and text, and left out. Null and empty texts are
    equal to each other and one of them stays; of rows that repeat identifier and text one stays; rows without
    an identifier stay unless a row that has one is linked to them. All columns come back as they were,
    whatever their names; an empty table gives an empty result.
    """
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = durable(simhash_groups(named, carry=["doc_id", "text_hash"]))
    # The kept row of a component: the smallest identifier, then the smallest hash.
    best = found.groupBy("component_id").agg(F.min(F.when(
        F.col("doc_id") == F.col("component_id"), F.struct("doc_id", "text_hash"))).alias("best"))
    # Components of rows without an identifier have no name; all of their rows stay.
    gone = found.where("component_id is not null").join(best, "component_id").where(
        ~F.struct("doc_id", "text_hash").eqNullSafe(F.col("best")))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    gone = gone.select(name.alias("name"), F.col("text_hash").alias("hash")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), name.alias("name"), F.xxhash64("text").alias("hash"))
    kept = rows.join(gone, ["name", "hash"], "left_anti")
    if found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        return kept.select("row.*")
    # Rows that repeat identifier and text: one stays.
    again = Window.partitionBy("row.doc_id", "row.text").orderBy(F.lit(0))
    return kept.withColumn("n", F.row_number().over(again)).where("n = 1").select("row.*")
