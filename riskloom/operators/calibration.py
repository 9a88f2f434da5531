"""Isotonic calibration by pooling adjacent violators, in pieces that merge.

Pooling is associative: the blocks that remain of consecutive ranges of points, pooled again
side by side, give the blocks of the whole. So points are numbered in order, cut into ranges
of bounded size, and each range is pooled by itself; what remains is numbered anew and cut at
other places, until no two neighbours violate the order or little enough remains for one
range. A range that grew together counts as one block afterwards, so few rounds suffice.

The fitted map is flat over a block and linear between blocks; values beyond the ends take
the value at the end. For labels 0 and 1 it has of the order of n^(2/3) blocks for n points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.ordered import ONE_TASK_ROWS, block_prefix, running_totals
from riskloom.session import durable

_BLOCKS = "low double, high double, total double, weight double"


def pool(low: np.ndarray, high: np.ndarray, total: np.ndarray, weight: np.ndarray) -> list[list[float]]:
    """The blocks that remain of consecutive ones: [low, high, total, weight], means ascending."""
    stack: list[list[float]] = []
    for block in zip(low.tolist(), high.tolist(), total.tolist(), weight.tolist()):
        block = list(block)
        while stack and stack[-1][2] * block[3] >= block[2] * stack[-1][3]:
            before = stack.pop()
            block = [before[0], block[1], before[2] + block[2], before[3] + block[3]]
        stack.append(block)
    return stack


def _pool_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by range, in order; what remains of a range goes on until the next begins."""
    held, current = [], None
    for batch in batches:
        for number, rows in batch.groupby("range", sort=False):
            if current is not None and number != current:
                yield pd.DataFrame(held, columns=["low", "high", "total", "weight"])
                held = []
            current = number
            if held:
                rows = pd.concat([pd.DataFrame(held, columns=["low", "high", "total", "weight"]), rows])
            held = pool(*(rows[c].to_numpy() for c in ("low", "high", "total", "weight")))
    if held:
        yield pd.DataFrame(held, columns=["low", "high", "total", "weight"])


def isotonic_blocks(points: DataFrame, value: str = "value", label: str = "label", range_rows: int = ONE_TASK_ROWS // 4) -> DataFrame:
    """The blocks of the isotonic fit of ``label`` on ``value``: ``low, high, total, weight``.

    Equal values are one point. Rows without a value or a label don't count; no rows, no block.
    No task holds more than ``range_rows`` blocks.
    """
    known = points.where(F.col(value).isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
    blocks = durable(known.groupBy(F.col(value).cast("double").alias("low")).agg(
        F.sum(F.col(label).cast("double")).alias("total"), F.count("*").cast("double").alias("weight")
    ).select("low", F.col("low").alias("high"), "total", "weight"))
    left, turn = blocks.count(), 0
    while True:
        if left <= range_rows:
            numbered = blocks.withColumn("range", F.lit(0))
        else:
            place = running_totals(blocks.withColumn("one", F.lit(1)), [], ["low"], ["one"], rows_bound=left, one_task_rows=range_rows)
            # Cuts of one round lie in the middle of the ranges of the next.
            shift = (turn % 2) * (range_rows // 2)
            numbered = place.withColumn("range", F.floor((F.col("one_before") + shift) / range_rows)).select(*blocks.columns, "range")
        pooled = durable(numbered.repartition("range").sortWithinPartitions("range", "low")
                         .mapInPandas(_pool_ranges, _BLOCKS))
        done, before = left <= range_rows, left
        blocks, left, turn = pooled, pooled.count(), turn + 1
        if done or (left == before and turn > 1 and _ascending(blocks, left, range_rows)):
            return blocks


def _ascending(blocks: DataFrame, rows: int, range_rows: int) -> bool:
    """Whether no block has a mean below that of the one before."""
    place = running_totals(blocks.withColumn("one", F.lit(1)), [], ["low"], ["one"], rows_bound=rows, one_task_rows=range_rows)
    parts = place.select("low", "one", F.floor(F.col("one_before") / range_rows).alias("part"), F.lit(0).alias("all"),
                         (F.col("total") / F.col("weight")).alias("mean"))
    before = block_prefix(parts, ["all"], "part", ["low"], ["one"], previous="mean")
    return before.where("previous_mean >= mean").isEmpty()


@dataclass
class IsotonicMap:
    """A fitted map as knots: ascending values with their calibrated probabilities."""

    knots: np.ndarray
    values: np.ndarray

    @staticmethod
    def fit(points: DataFrame, value: str = "value", label: str = "label", **limits) -> "IsotonicMap":
        blocks = isotonic_blocks(points, value, label, **limits)
        ends = F.array("low", "high")
        # The map itself, which every scoring task holds.
        rows = blocks.select(F.explode(F.array_distinct(ends)).alias("knot"), (F.col("total") / F.col("weight")).alias("p")
                             ).orderBy("knot").toPandas()
        return IsotonicMap(rows["knot"].to_numpy(np.float64), rows["p"].to_numpy(np.float64))

    def apply(self, rows: DataFrame, value: str, output: str) -> DataFrame:
        """Add ``output``; a missing value has none, and a map without knots gives none."""
        knots, values = self.knots, self.values
        if not len(knots):
            return rows.withColumn(output, F.lit(None).cast("double"))
        sent = rows.sparkSession.sparkContext.broadcast((knots, values))

        @F.pandas_udf("double")
        def calibrated(x: pd.Series) -> pd.Series:
            known = x.notna()
            out = pd.Series(np.interp(x.to_numpy(np.float64), *sent.value), index=x.index)
            return out.where(known)

        return rows.withColumn(output, calibrated(F.col(value).cast("double")))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(pd.DataFrame({"knot": self.knots, "p": self.values}), "knot double, p double").write.mode(
            "overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IsotonicMap":
        rows = spark.read.parquet(path).orderBy("knot").toPandas()
        return IsotonicMap(rows["knot"].to_numpy(np.float64), rows["p"].to_numpy(np.float64))
