"""Labelled rows, chronological split, model matrix and class weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import micros
from riskloom.schemas import ID_COLUMNS, PAYMENT_METHODS


def labelled_rows(features: DataFrame, ground_truth: DataFrame) -> DataFrame:
    """Feature rows with their label; a row without one keeps a null label."""
    return features.join(
        ground_truth.select("transaction_id", "fraud_label"), "transaction_id", "left")


def cut_offs(df: DataFrame, ts: str = "timestamp", train: float = 0.70,
             val: float = 0.15) -> tuple[int, int]:
    """Ends of the train and validation spans, in microseconds since 1970."""
    low, high = df.agg(F.min(micros(ts)), F.max(micros(ts))).first()
    if low is None:
        return 0, 0
    return tuple(low + math.floor((high - low) * share) for share in (train, train + val))


def with_split(df: DataFrame, ts: str = "timestamp", cuts: tuple[int, int] | None = None,
               train: float = 0.70, val: float = 0.15) -> DataFrame:
    """Add ``split`` (train, val, test) by cut-off instants at shares of the time span.

    ``cuts`` are known cut-offs; without them they are read off ``df`` itself.
    """
    train_end, val_end = cuts or cut_offs(df, ts, train, val)
    at = micros(ts)
    return df.withColumn("split", F.when(at < train_end, "train").when(at < val_end, "val")
                         .otherwise("test"))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("rows"))


def one_hot(column: str = "payment_method",
            values: list[str] = PAYMENT_METHODS) -> list[Column]:
    """One 0/1 column per known value; a value outside the list gives all zeros."""
    return [
        F.when(F.col(column) == v, 1).otherwise(0).alias(f"{column}_{v}") for v in values
    ]


def model_matrix(features: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Model inputs: ids dropped, payment method one-hot, appended last.

    ``keep`` names columns carried along in front (a key, the label, the split).
    """
    keep = keep or []
    inputs = [c for c in features.columns
              if c not in ID_COLUMNS and c not in keep and c != "payment_method"]
    return features.select(*keep, *inputs, *one_hot())


def class_weights(rows: DataFrame, label: str = "fraud_label") -> DataFrame:
    """Class counts, the negative/positive ratio, and balanced weights n / (2 n_c)."""
    counts = rows.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    n = F.col("positives") + F.col("negatives")
    return counts.select(
        "positives", "negatives",
        (F.col("negatives") / F.greatest("positives", F.lit(1))).alias("scale_pos_weight"),
        F.try_divide(n, 2 * F.col("positives")).alias("weight_positive"),
        F.try_divide(n, 2 * F.col("negatives")).alias("weight_negative"),
    )
