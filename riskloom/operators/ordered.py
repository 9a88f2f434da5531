"""Running totals and exact order statistics over groups of any size.

A window with no partition key, or with one huge key, runs in a single task.
Here such a group is cut into blocks of consecutive rows: totals per block give
each block its starting value, and the rows only need a window inside their block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.session import durable

# A group up to this many rows is sorted in one task.
ONE_TASK_ROWS = 2_000_000
#: Number of a row's block, where an operator keeps it.
BLOCK = "__block"


def block_prefix(df: DataFrame, keys: list[str], block: str, order: list[str],
                 measures: list[str], previous: str | None = None) -> DataFrame:
    """Add ``<m>_before``, the sum of ``m`` over earlier rows of the same key, and
    ``<m>_total``, its sum over the key.

    ``block`` must not decrease along ``order`` inside a key, and keys are not null.
    With ``previous``, also add ``previous_<col>``, that column's value on the row before.
    """
    inside = (
        W.partitionBy(*keys, block).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    )
    totals = df.groupBy(*keys, block).agg(
        *[F.sum(m).alias(f"{m}__total") for m in measures],
        *([F.max(previous).alias("__last")] if previous else []),
    )
    # One row per block and key: the number of blocks, not of rows, bounds this window.
    across = W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        *keys, block,
        *[F.sum(f"{m}__total").over(across).alias(f"{m}__carry") for m in measures],
        *[F.sum(f"{m}__total").over(W.partitionBy(*keys)).alias(f"{m}_total") for m in measures],
        *([F.max("__last").over(across).alias("__prior")] if previous else []),
    )
    marked = df.select(
        "*", *[F.sum(m).over(inside).alias(f"{m}__inside") for m in measures],
        *([F.max(previous).over(inside).alias("__near")] if previous else []),
    )
    zero = F.lit(0)
    return marked.join(carry, [*keys, block], "left").select(
        *df.columns,
        *[
            (F.coalesce(f"{m}__carry", zero) + F.coalesce(f"{m}__inside", zero))
            .alias(f"{m}_before")
            for m in measures
        ],
        *[f"{m}_total" for m in measures],
        *([F.coalesce("__near", "__prior").alias(f"previous_{previous}")] if previous else []),
    )


def largest_group(df: DataFrame, keys: list[str]) -> int:
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def running_totals(df: DataFrame, keys: list[str], order: list[str], measures: list[str],
                   previous: str | None = None, rows_bound: int | None = None,
                   one_task_rows: int = ONE_TASK_ROWS, keep_block: bool = False) -> DataFrame:
    """Add ``<m>_before`` and ``<m>_total`` for every measure; rows must be unique per
    (keys, order).

    ``rows_bound`` is a known upper bound on the rows of the largest group; when
    absent it is measured. Groups beyond ``one_task_rows`` are cut into blocks by
    range partitioning on (keys, order), which splits any key, however large and
    however its values cluster. The block of a row depends on the sampled range
    bounds, so the partitioned rows are made durable before they are used twice. With
    ``keep_block`` (and blocks, ``one_task_rows=0``) rows keep the number of theirs.
    """
    if rows_bound is None and one_task_rows > 0:
        rows_bound = largest_group(df, keys)
    if one_task_rows > 0 and rows_bound <= one_task_rows:
        one = df.withColumn(BLOCK, F.lit(0))
        inside = W.partitionBy(*keys, BLOCK).orderBy(*order)
        before = inside.rowsBetween(W.unboundedPreceding, -1)
        return one.select(
            *df.columns,
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}_before") for m in measures],
            *[F.sum(m).over(W.partitionBy(*keys, BLOCK)).alias(f"{m}_total") for m in measures],
            *([F.max(previous).over(before).alias(f"previous_{previous}")] if previous else []),
        )
    cut = durable(
        df.repartitionByRange(*keys, *order).withColumn(BLOCK, F.spark_partition_id())
    )
    out = block_prefix(cut, keys, BLOCK, order, measures, previous)
    return out if keep_block else out.drop(BLOCK)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float],
                    weight: str | None = None, rows_bound: int | None = None,
                    one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Linearly interpolated quantiles per key: columns keys, ``probability``, ``quantile``.

    Equal values collapse before the sort, and each quantile is read from the two
    rows whose ranks it needs, so no group is ever held in memory.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        (F.sum(weight) if weight else F.count("*")).alias("n")
    )
    if rows_bound is None:
        counted = durable(counted)  # measured before they are ordered
    ranked = running_totals(counted, keys, [value], ["n"], rows_bound=rows_bound,
                            one_task_rows=one_task_rows)
    # Per quantile: the ranks on either side of its position, kept by the rows owning them.
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1
    spots = F.array(*[
        F.struct(F.lit(p).alias("probability"), (F.lit(p) * (F.col("n_total") - 1)).alias("position"))
        for p in probabilities
    ])
    owned = F.filter(
        spots, lambda s: (F.ceil(s["position"]) >= first) & (F.floor(s["position"]) <= last)
    )
    hits = ranked.select(*keys, value, first.alias("first"), last.alias("last"),
                        F.inline(owned).alias("probability", "position"))
    low, high = F.floor("position"), F.ceil("position")
    return hits.groupBy(*keys, "probability", "position").agg(
        F.max(F.when(low.between(F.col("first"), F.col("last")), F.col(value))).alias("low"),
        F.max(F.when(high.between(F.col("first"), F.col("last")), F.col(value))).alias("high"),
    ).select(
        *keys, "probability",
        (F.col("low") + (F.col("high") - F.col("low")) * (F.col("position") - low))
        .alias("quantile"),
    )


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp (the session runs in UTC)."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))
