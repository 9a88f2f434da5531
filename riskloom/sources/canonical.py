"""The entity tables, derived from the event and customer tables at hand.

``events`` play the part of transactions: a user is a customer, ``props.k`` a
merchant, and a user's three device slots are its devices. Country changes, fraud
labels and scores follow from fixed rules on the ids.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import COUNTRIES, MERCHANT_CATEGORIES
from riskloom.session import prepare


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


class Tables:
    """Lazy canonical tables over one data folder."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = prepare(spark)
        self.data_dir = data_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def _transactions_plus(self) -> DataFrame:
        customers = self.raw("customer").select("c_custkey", "c_nationkey")
        e = F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("int")
        base = self.raw("events").join(customers, F.col("user_id") == F.col("c_custkey"), "left").select(
            "event_id", "user_id", k.alias("k"), "ts", "value", "event_type",
            (F.col("c_nationkey") % 7).alias("home"),
        ).withColumn(
            "at",
            F.when(e % 33 == 0, (F.col("home") + 1 + F.floor(e / 33) % 6) % 7)
            .otherwise(F.col("home")),
        )
        error = F.col("event_type") == "error"
        label = (error & ((F.col("k") >= 90) | (e % 10 == 0))).cast("int")
        return base.select(
            "event_id",
            _padded("TXN", e, 10).alias("transaction_id"),
            _padded("CUST", F.col("user_id"), 7).alias("customer_id"),
            _padded("MERC", F.col("k"), 6).alias("merchant_id"),
            _padded("DEV", F.col("user_id") * 3 + F.col("k") % 3, 7).alias("device_id"),
            F.col("ts").alias("timestamp"),
            F.col("value").alias("amount"),
            F.when(e % 10 < 7, "card").when(e % 10 < 9, "wallet").otherwise("bank_transfer")
            .alias("payment_method"),
            _pick(COUNTRIES, F.col("at")).alias("country"),
            _pick(COUNTRIES, F.when(e % 47 == 0, (F.col("at") + 1) % 7).otherwise(F.col("at")))
            .alias("ip_country"),
            _pick(COUNTRIES, F.col("home")).alias("home_country"),
            label.alias("fraud_label"),
            F.when(label == 1, F.col("ts") + F.make_dt_interval((e % 15).cast("int")))
            .alias("confirmed_fraud_at"),
            (F.col("k") / 200.0 + F.when(error, 0.3).otherwise(0.0) + F.col("value") / 2500.0)
            .alias("model_score"),
            F.col("k").alias("merchant_number"),
        )

    def transactions_plus(self) -> DataFrame:
        """Transactions with home country, label, confirmation and score carried along."""
        return self._transactions_plus

    def transactions(self) -> DataFrame:
        return self.transactions_plus().select(
            "transaction_id", "customer_id", "merchant_id", "device_id", "timestamp", "amount",
            "payment_method", "country", "ip_country",
        )

    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            _padded("CUST", F.col("c_custkey"), 7).alias("customer_id"),
            F.lower("c_mktsegment").alias("customer_segment"),
            _pick(COUNTRIES, F.col("c_nationkey") % 7).alias("home_country"),
        )

    def devices(self) -> DataFrame:
        return self.transactions().groupBy("device_id").agg(
            F.min("customer_id").alias("customer_id"), F.min("timestamp").alias("first_seen_at")
        )

    def merchants(self) -> DataFrame:
        return self.transactions_plus().select("merchant_id", "merchant_number").distinct().select(
            "merchant_id",
            _pick(MERCHANT_CATEGORIES, F.col("merchant_number") % 8).alias("merchant_category"),
        )

    def ground_truth(self) -> DataFrame:
        return self.transactions_plus().select(
            "transaction_id", "fraud_label", "confirmed_fraud_at")

    def scored(self) -> DataFrame:
        """Score, label, amount and time of every transaction."""
        return self.transactions_plus().select(
            "transaction_id", "timestamp", "amount", "fraud_label", "model_score")
