"""Exact expanding quantile for groups too large for one task.

Row i of a group needs a quantile of the i values before it. Rows are cut, in time
order, into blocks of equal size. Within a block the quantile's rank moves by at
most one block of rows, so a block needs only a short slice of the sorted values
that precede it, plus its own rows. The slices are found by counting, and each
(group, block) is then a small bounded piece of work.
"""

from __future__ import annotations

import math
from bisect import insort
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.ordered import BLOCK, largest_group, running_totals
from riskloom.session import durable


def expanding_values(values: np.ndarray, q: float, min_prior: int) -> np.ndarray:
    """Per value, the q-quantile of the values before it; NaN with fewer than ``min_prior``.
    A missing value adds nothing to what comes after it.

    Two heaps meet at the quantile: ``low`` (negated) holds the smallest values up to its
    lower rank, ``high`` the rest. The rank moves by at most one per value.
    """
    out = np.full(len(values), np.nan)
    low, high = [], []
    i = -1  # values so far, less one
    for row, v in enumerate(values):
        i += 1
        if i >= max(min_prior, 1):
            place = q * (i - 1)
            share = place - int(place)
            floor = -low[0]
            out[row] = floor + (high[0] - floor) * share if share > 0 else floor
        if v != v or v is None:
            i -= 1
            continue
        if low and v < -low[0]:
            heappush(low, -v)
        else:
            heappush(high, v)
        keep = int(q * i) + 1  # values at or below the lower rank among i + 1
        while len(low) < keep:
            heappush(low, -heappop(high))
        while len(low) > keep:
            heappush(high, -heappop(low))
    return out


def _key(rows: pd.DataFrame, keys: list[str], place: int) -> list:
    values = [rows[k].iloc[place] for k in keys]
    return [None if pd.isna(v) else v for v in values]


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches of rows that come sorted by ``keys``, cut so that no group is parted: rows and the
    places where their groups begin, the end included. Small groups share a batch, which spares a
    frame for each of them."""
    held: list[pd.DataFrame] = []

    def cut(parts: list[pd.DataFrame]) -> tuple[pd.DataFrame, np.ndarray]:
        rows = pd.concat(parts, ignore_index=True)
        number = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        return rows, np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(rows)]])

    for batch in batches:
        if not len(batch):
            continue
        number = batch.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        others = np.flatnonzero(number != number[-1])
        start = int(others[-1]) + 1 if len(others) else 0
        if start or (held and _key(batch, keys, 0) != _key(held[-1], keys, -1)):
            yield cut([*held, batch.iloc[:start]])
            held = []
        held.append(batch.iloc[start:])
    if held:
        yield cut(held)


def row_positions(rows: DataFrame, keys: list[str], order: list[str],
                  value: str | None = None) -> DataFrame:
    """Add ``pos``: 0-based place of the row within its key, and with ``value`` also
    ``pos_<value>``: its place among the rows that have one, and the block the place was counted in, which rises
    with it. Splits keys of any size."""
    counts = {"pos": F.lit(1)}
    if value:
        counts[f"pos_{value}"] = F.col(value).isNotNull().cast("int")
    marked = rows.withColumns({f"__{n}": c for n, c in counts.items()})
    numbered = running_totals(marked, keys, order, [f"__{n}" for n in counts], one_task_rows=0, keep_block=True)
    # Read several times below, so keep one written copy.
    return durable(numbered.select(
        *rows.columns, BLOCK, *[F.col(f"__{n}_before").alias(n) for n in counts]))


def expanding_quantile(positioned: DataFrame, key: str, row_id: str, value: str, q: float,
                       min_prior: int, block_rows: int = 50_000, salts: int = 64) -> DataFrame:
    """``row_id`` and the ``quantile`` over the earlier values of its key (linear
    interpolation; null with fewer than ``min_prior`` of them).

    ``positioned`` carries ``pos`` from ``row_positions``.
    """
    # The counting grid has (rows / block)^2 cells per key: keep it below the row count.
    size = max(block_rows, math.isqrt(largest_group(positioned, [key])) + 1)
    rows = positioned.select(
        F.col(key).alias("k"), F.col(row_id).alias("rid"), F.col(value).alias("v"), "pos",
        F.floor(F.col("pos") / size).alias("blk"),
    )
    by_value = running_totals(
        rows.select("k", "v", "pos", "blk", F.lit(1).alias("one")), ["k"], ["v", "pos"], ["one"],
        one_task_rows=0,
    ).select("k", "v", "pos", "blk", F.floor(F.col("one_before") / size).alias("vb"))

    slices = _needed_slices(by_value, size, q)
    spread = by_value.withColumn("salt", F.col("pos") % salts)
    wanted = slices.withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    ).withColumn("salt", F.col("salt").cast("bigint"))
    values = spread.join(wanted, ["k", "vb", "salt"]).where("blk < j").select(
        "k", F.col("j").alias("blk"), "v", F.lit(-1).cast("bigint").alias("pos"), "below",
        F.lit(None).cast(rows.schema["rid"].dataType).alias("rid"))
    # A block's slice comes first, in order of value, then the block's own rows in their order.
    together = rows.select("k", "blk", "v", "pos", F.lit(0).cast("bigint").alias("below"), "rid").unionByName(values)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, edges in whole_groups(batches, ["k", "blk"]):
            value, place_of = block["v"].to_numpy(np.float64), block["pos"].to_numpy()
            below_of, out = block["below"].to_numpy(), np.full(len(block), np.nan)
            for first, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                own = first + int(np.searchsorted(place_of[first:end], 0))
                kept = value[first:own].tolist()
                below = int(below_of[first]) if own > first else 0
                for row, pos, v in zip(range(own, end), place_of[own:end].tolist(), value[own:end].tolist()):
                    if pos >= max(min_prior, 1):
                        place = q * (pos - 1)
                        at = int(place) - below
                        low = kept[at]
                        high = kept[min(at + 1, len(kept) - 1)]
                        out[row] = low + (high - low) * (place - int(place))
                    insort(kept, v)
            mine = place_of >= 0
            yield pd.DataFrame({"rid": block["rid"][mine], "v": value[mine], "quantile": out[mine]})

    rid_type = positioned.schema[row_id].dataType.simpleString()
    walked = together.repartition("k", "blk").sortWithinPartitions("k", "blk", "pos", "v").mapInPandas(
        walk, f"rid {rid_type}, v double, quantile double")
    return walked.select(F.col("rid").alias(row_id), F.col("v").alias(value),
                         F.when(~F.isnan("quantile"), F.col("quantile")).alias("quantile"))


def _needed_slices(by_value: DataFrame, size: int, q: float) -> DataFrame:
    """Value buckets each block must see: columns k, vb, j and ``below``, the number of
    preceding values under the slice."""
    cells = by_value.groupBy("k", "vb", "blk").agg(F.count("*").alias("n"))
    spans = cells.groupBy("k").agg(F.max("blk").alias("last"))
    # n counts the bucket's values in blocks before j, for every j: fill the grid between
    # one counted block and the next.
    per_bucket = W.partitionBy("k", "vb").orderBy("blk")
    grid = cells.join(spans, "k").select(
        "k", "vb",
        F.sum("n").over(per_bucket.rowsBetween(W.unboundedPreceding, 0)).alias("c"),
        (F.col("blk") + 1).alias("from_j"),
        F.coalesce(F.lead("blk").over(per_bucket), F.col("last")).alias("to_j"),
    ).where("from_j <= to_j").select(
        "k", "vb", "c", F.explode(F.sequence("from_j", "to_j")).alias("j"))
    along = W.partitionBy("k", "j").orderBy("vb").rowsBetween(W.unboundedPreceding, -1)
    ranked = grid.withColumn("start", F.coalesce(F.sum("c").over(along), F.lit(0)))
    lowest = F.floor(q * (F.col("j") * size - 1) - 1 - (1 - q) * size)
    highest = F.floor(q * (F.col("j") + 1) * size) + 1
    needed = ranked.where((F.col("start") + F.col("c") > lowest) & (F.col("start") <= highest))
    first = F.min("start").over(W.partitionBy("k", "j"))
    return needed.select("k", "vb", "j", first.alias("below"))
