"""Handling of keys that own a large share of the rows.

A key window or key join puts all rows of one key in one task. That is the
cheapest plan for ordinary keys, so operators keep it for them and send only the
few *heavy* keys through a plan that splits a key over many tasks. Which keys are
heavy is measured, with an aggregate that combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import durable

# At most this many keys are ever treated as heavy, which bounds what is broadcast.
# With N rows in all, a key outside the largest MAX_HEAVY holds at most
# N / MAX_HEAVY of them, so leaving it on the one-task-per-key plan is safe.
MAX_HEAVY = 100_000


def heavy_keys(df: DataFrame, keys: list[str], min_rows: int,
               max_keys: int = MAX_HEAVY) -> DataFrame | None:
    """Keys owning more than ``min_rows`` rows, or None when there are none.

    Runs one column-pruned job. The result is a stored table of at most ``max_keys`` rows
    (the largest ones), carries ``key_rows``, and is safe to broadcast.
    """
    found = durable(
        df.groupBy(*keys).agg(F.count("*").alias("key_rows"))
        .where(F.col("key_rows") > min_rows)
        .orderBy(F.desc("key_rows"), *keys)
        .limit(max_keys)
    )
    return None if found.isEmpty() else found


def key_profile(df: DataFrame, keys: list[str]) -> dict[str, tuple[int, int]]:
    """{key: (rows in all, rows of its largest value)}, in one column-pruned job."""
    named = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value"))
                      for k in keys])
    sizes = df.select(F.inline(named)).groupBy("key", "value").agg(F.count("*").alias("n"))
    profile = sizes.groupBy("key").agg(F.sum("n").alias("rows"), F.max("n").alias("largest"))
    found = {r["key"]: (r["rows"], r["largest"]) for r in profile.collect()}
    return {k: found.get(k, (0, 0)) for k in keys}


def split(df: DataFrame, heavy: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of heavy keys). Null keys count as ordinary."""
    names = F.broadcast(heavy.select(*keys))
    return df.join(names, keys, "left_anti"), df.join(names, keys, "left_semi")


def lookup(rows: DataFrame, dim: DataFrame, key: str, how: str = "left",
           heavy: DataFrame | None = None) -> DataFrame:
    """Join ``rows`` to a table holding one row per ``key``.

    Heavy keys are joined to their (at most MAX_HEAVY) dimension rows by
    broadcast, so their rows never meet in one task; the others use whatever join
    the optimiser picks from the sizes it knows.
    """
    if heavy is None:
        return rows.join(dim, key, how)
    ordinary, large = split(rows, heavy, [key])
    _, large_dim = split(dim, heavy, [key])
    return ordinary.join(dim, key, how).unionByName(
        large.join(F.broadcast(large_dim), key, how)
    )
