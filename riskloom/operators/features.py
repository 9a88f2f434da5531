"""Point-in-time transaction features: six families and the assembled table.

Every family looks only at what was known before the transaction. Each function
returns ``transaction_id`` plus its columns. Transactions of ordinary customers
and merchants are handled by key windows; heavy keys (see ``skew``) by running
totals that split the key, so that both give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalar import clip, differs
from riskloom.operators import skew
from riskloom.operators.expanding import expanding_quantile, expanding_values, row_positions, whole_groups
from riskloom.operators.ordered import BLOCK, ONE_TASK_ROWS, block_prefix, micros, running_totals
from riskloom.schemas import FEATURE_COLUMNS, FEATURES
from riskloom.session import durable

# Fixed values of the feature definitions.
NIGHT_HOURS = [1, 2, 3, 4]
MIN_AMOUNT_HISTORY = 5
AMOUNT_QUANTILE = 0.95
AMOUNT_EPSILON = 1e-6
DEFAULT_AMOUNT_RATIO = 1.0
MIN_MERCHANT_HISTORY = 20
HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


@dataclass(frozen=True)
class Limits:
    """Group sizes up to which each plan is used.

    Trailing counts and expanding quantiles as windows cost more than linear time per
    customer, so windows serve customers up to ``window_rows``; beyond that a customer's
    rows are worked through as one group. The other limits bound what one task sorts
    comfortably: larger keys are split.
    """

    window_rows: int = 1_000
    customer_rows: int = 1_000_000
    device_rows: int = 1_000_000
    merchant_rows: int = 1_000_000
    quantile_block_rows: int = 50_000
    one_task_rows: int = ONE_TASK_ROWS


DEFAULT_LIMITS = Limits()


class HeavyKeys:
    """Which keys of a transaction table are heavy, measured once for several operators."""

    def __init__(self, transactions: DataFrame, limits: Limits, *keys: str):
        bounds = {"customer_id": limits.customer_rows, "device_id": limits.device_rows,
                  "merchant_id": limits.merchant_rows}
        profile = skew.key_profile(transactions, list(keys))
        self.rows = max(rows for rows, _ in profile.values())
        self.largest = {k: largest for k, (_, largest) in profile.items()}
        self._found = {
            k: skew.heavy_keys(transactions, [k], bounds[k]) if largest > bounds[k] else None
            for k, (_, largest) in profile.items()
        }

    def __getitem__(self, key: str) -> DataFrame | None:
        return self._found[key]


# ---------------------------------------------------------------- row-level

def transaction_columns() -> dict[str, Column]:
    hour = F.hour("timestamp").cast("bigint")
    return {
        "hour_of_day": hour,
        "is_night": hour.isin(NIGHT_HOURS).cast("int"),
        "is_cross_border": differs("country", "home_country"),
    }


def transaction_features(transactions: DataFrame, customers: DataFrame,
                         limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    heavy = HeavyKeys(transactions, limits, "customer_id")
    rows = skew.lookup(
        transactions.select("transaction_id", "customer_id", "timestamp", "amount",
                            "payment_method", "country"),
        customers.select("customer_id", "home_country"), "customer_id",
        heavy=heavy["customer_id"],
    )
    return rows.select(
        "transaction_id", "amount", "payment_method",
        *[c.alias(n) for n, c in transaction_columns().items()],
    )


# ---------------------------------------------------------------- per customer

_TIME_ORDER = ["__us", "transaction_id"]


def _windowed(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """Add the wanted columns as windows over one customer's timeline.

    They share one partitioning and one sort order. The growing sets hold a
    customer's countries and devices, which are few against its rows. In every plan a
    missing amount adds nothing to the history, a missing country is not a new one, and a
    missing device does not count.
    """
    timeline = W.partitionBy("customer_id")
    before = timeline.orderBy(*_TIME_ORDER).rowsBetween(W.unboundedPreceding, -1)
    seen_here = F.coalesce(
        F.array_contains(F.collect_set("country").over(before), F.col("country")), F.lit(False))

    def trailing(width: int) -> Column:
        # [t - width, t): the left edge counts, the transaction's own instant does not.
        return F.count("*").over(timeline.orderBy("__us").rangeBetween(-width, -1))

    columns = {
        "is_new_country_for_customer": lambda: (
            F.col("country").isNotNull() & ~seen_here).cast("int"),
        "customer_device_count_so_far": lambda: F.size(
            F.collect_set("device_id").over(before)).cast("bigint"),
        "txn_count_1h": lambda: trailing(HOUR_US),
        "txn_count_24h": lambda: trailing(DAY_US),
    }
    out = rows
    if "amount_vs_customer_p95" in wanted:
        # Sorted as plain numbers, which costs half of a percentile per row. The arrays end here.
        known = rows.withColumn("__known", F.sort_array(F.collect_list("amount").over(before)))
        out = known.select(*rows.columns, _amount_ratio(_quantile_of_sorted("__known")).alias("amount_vs_customer_p95"))
    return out.select("*", *[columns[n]().alias(n) for n in wanted if n in columns]).select(*rows.columns, *wanted)


def _quantile_of_sorted(values: str) -> Column:
    """As ``percentile`` interpolates; null with fewer values than a history needs."""
    place = F.lit(AMOUNT_QUANTILE) * (F.size(values) - 1)
    below, above = F.floor(place), F.ceil(place)
    low, high = (F.get(values, i.cast("int")) for i in (below, above))
    return F.when(F.size(values) >= MIN_AMOUNT_HISTORY, F.when(low == high, low).otherwise(
        (above - place) * low + (place - below) * high))


def _amount_ratio(p95: Column) -> Column:
    return F.coalesce(F.col("amount") / (p95 + AMOUNT_EPSILON), F.lit(DEFAULT_AMOUNT_RATIO))


def _heavy_trailing_counts(rows: DataFrame, limits: Limits) -> DataFrame:
    """Trailing counts as differences of running counts, for customers of any size.

    The count in [t - w, t) is (rows before t) - (rows before t - w). Both running
    counts are read off one ordered set of distinct instants per customer.
    """
    marks = {"t": 0, "h": HOUR_US, "d": DAY_US}
    probes = rows.select(
        "transaction_id", "customer_id",
        F.inline(F.array(*[
            F.struct(F.lit(m).alias("mark"), (F.col("__us") - w).alias("at"))
            for m, w in marks.items()
        ])).alias("mark", "at"),
    )
    instants = probes.groupBy("customer_id", "at").agg(
        F.sum((F.col("mark") == "t").cast("bigint")).alias("n")
    )
    counted = running_totals(instants, ["customer_id"], ["at"], ["n"],
                             one_task_rows=limits.one_task_rows)
    found = probes.join(counted, ["customer_id", "at"])
    seen = {m: F.max(F.when(F.col("mark") == m, F.col("n_before"))) for m in marks}
    return found.groupBy("transaction_id").agg(
        (seen["t"] - seen["h"]).alias("txn_count_1h"),
        (seen["t"] - seen["d"]).alias("txn_count_24h"),
    )


def _heavy_first_uses(positioned: DataFrame, column: str) -> DataFrame:
    """Rows with ``first``: 1 on the customer's first row with this value of ``column``."""
    firsts = positioned.where(F.col(column).isNotNull()).groupBy("customer_id", column).agg(F.min("pos").alias("pos")).select(
        "customer_id", "pos", F.lit(1).alias("first"))
    return positioned.select("transaction_id", "customer_id", "pos", BLOCK).join(
        firsts, ["customer_id", "pos"], "left").fillna(0, ["first"])


def _grouped(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns for customers that fit one group but are long for windows."""
    columns = rows.columns

    def history(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group, edges in whole_groups(batches, ["customer_id"]):
            sizes = np.diff(edges)
            customer = pd.Series(np.repeat(np.arange(len(sizes)), sizes))
            spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
            if {"txn_count_1h", "txn_count_24h"} & set(wanted):
                us = group["__us"].to_numpy()
                spent = {n: w for n, w in (("txn_count_1h", HOUR_US), ("txn_count_24h", DAY_US)) if n in wanted}
                counts = {n: np.empty(len(group), np.int64) for n in spent}
                for first, end in spans:
                    own = us[first:end]
                    before = np.searchsorted(own, own, side="left")
                    for name, width in spent.items():
                        counts[name][first:end] = before - np.searchsorted(own, own - width, side="left")
                group = group.assign(**counts)
            if "amount_vs_customer_p95" in wanted:
                amount = group["amount"].to_numpy(np.float64)
                p95 = np.concatenate([expanding_values(amount[first:end], AMOUNT_QUANTILE, MIN_AMOUNT_HISTORY)
                                      for first, end in spans])
                group["amount_vs_customer_p95"] = pd.Series(amount / (p95 + AMOUNT_EPSILON)).fillna(DEFAULT_AMOUNT_RATIO)
            if "is_new_country_for_customer" in wanted:
                known = pd.DataFrame({"customer": customer, "value": group["country"]})
                group["is_new_country_for_customer"] = (
                    ~known.duplicated() & known["value"].notna()).astype("int32")
            if "customer_device_count_so_far" in wanted:
                known = pd.DataFrame({"customer": customer, "value": group["device_id"]})
                first = (~known.duplicated() & known["value"].notna()).to_numpy().astype(np.int64)
                earlier = first.cumsum() - first
                group["customer_device_count_so_far"] = earlier - np.repeat(earlier[edges[:-1]], sizes)
            yield group[columns + wanted]

    added = _windowed_schema(wanted)
    in_time = rows.repartition("customer_id").sortWithinPartitions(
        "customer_id", *[F.asc_nulls_last(c) for c in _TIME_ORDER])
    return in_time.mapInPandas(history, T.StructType(rows.schema.fields + added))


def _windowed_schema(wanted: list[str]) -> list[T.StructField]:
    return [T.StructField(c, FEATURES[c].dataType) for c in wanted]


def _ordinary_history(rows: DataFrame, wanted: list[str], limits: Limits,
                      largest: int) -> DataFrame:
    """Customers that fit one task: windows for the short ones, groups for the long ones.

    Which is which is a count over the customer, on the exchange both plans use.
    """
    if largest <= limits.window_rows:
        return _windowed(rows, wanted)
    sized = rows.withColumn("__n", F.count("*").over(W.partitionBy("customer_id")))
    short = sized.where(F.col("__n") <= limits.window_rows).drop("__n")
    long = sized.where(F.col("__n") > limits.window_rows).drop("__n")
    return _windowed(short, wanted).unionByName(_grouped(long, wanted))


def _customer_history(rows: DataFrame, wanted: list[str], limits: Limits,
                      measured: HeavyKeys) -> DataFrame:
    """Add the ``wanted`` per-customer columns to ``rows`` (which carry ``__us``)."""
    heavy, largest = measured["customer_id"], measured.largest["customer_id"]
    if heavy is None:
        return _ordinary_history(rows, wanted, limits, largest)
    ordinary, large = skew.split(rows, heavy, ["customer_id"])
    parts = []
    if {"txn_count_1h", "txn_count_24h"} & set(wanted):
        parts.append(_heavy_trailing_counts(large, limits))
    ordered = set(wanted) - {"txn_count_1h", "txn_count_24h"}
    if ordered:
        value = "amount" if "amount_vs_customer_p95" in ordered else None
        inputs = {"is_new_country_for_customer": "country", "customer_device_count_so_far": "device_id",
                  "amount_vs_customer_p95": "amount"}
        needed = large.select("customer_id", *_TIME_ORDER, *[inputs[n] for n in wanted if n in ordered])
        positioned = row_positions(needed, ["customer_id"], _TIME_ORDER, value)
    if "is_new_country_for_customer" in ordered:
        parts.append(_heavy_first_uses(positioned, "country").select(
            "transaction_id", F.col("first").alias("is_new_country_for_customer")))
    if "customer_device_count_so_far" in ordered:
        uses = _heavy_first_uses(positioned, "device_id")
        # The blocks of the positions serve again: both follow the customer's order.
        parts.append(block_prefix(uses, ["customer_id"], BLOCK, ["pos"], ["first"]).select(
                 "transaction_id",
                 F.col("first_before").cast("bigint").alias("customer_device_count_so_far")))
    if "amount_vs_customer_p95" in ordered:
        amounts = positioned.where("amount is not null").drop("pos", BLOCK).withColumnRenamed(
            "pos_amount", "pos")
        p95 = expanding_quantile(
            amounts, "customer_id", "transaction_id", "amount", AMOUNT_QUANTILE,
            MIN_AMOUNT_HISTORY, block_rows=limits.quantile_block_rows)
        parts.append(p95.select(
            "transaction_id", _amount_ratio(F.col("quantile")).alias("amount_vs_customer_p95")))
    for part in parts:
        large = large.join(part, "transaction_id", "left")
    if "amount_vs_customer_p95" in ordered:
        large = large.fillna(DEFAULT_AMOUNT_RATIO, ["amount_vs_customer_p95"])
    return _ordinary_history(ordinary, wanted, limits, largest).unionByName(
        large.select(*rows.columns, *wanted)
    )


def _customer_family(transactions: DataFrame, inputs: list[str], wanted: list[str],
                     limits: Limits) -> DataFrame:
    heavy = HeavyKeys(transactions, limits, "customer_id")
    rows = transactions.select("transaction_id", "customer_id", *inputs,
                               micros("timestamp").alias("__us"))
    return _customer_history(rows, wanted, limits, heavy)


def velocity_features(transactions: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    wanted = ["txn_count_1h", "txn_count_24h"]
    return _customer_family(transactions, [], wanted, limits).select("transaction_id", *wanted)


def behavioral_features(transactions: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    wanted = ["amount_vs_customer_p95"]
    return _customer_family(transactions, ["amount"], wanted, limits).select(
        "transaction_id", *wanted)


def geo_features(transactions: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    wanted = ["is_new_country_for_customer"]
    rows = _customer_family(transactions, ["country", "ip_country"], wanted, limits)
    return rows.select("transaction_id", *wanted,
                       differs("country", "ip_country").alias("ip_country_mismatch"))


# ---------------------------------------------------------------- per device

def _device_facts(transactions: DataFrame, devices: DataFrame) -> DataFrame:
    """One row per device: when it was registered and which transaction used it first.

    The first use is an aggregate that combines before the shuffle, so a device with
    many transactions costs no more than any other.
    """
    first_use = transactions.groupBy("device_id").agg(
        F.min(F.struct(micros("timestamp"), F.col("transaction_id"))).alias("__first")
    ).select("device_id", F.col("__first.transaction_id").alias("__first_transaction"))
    return first_use.join(devices.select("device_id", "first_seen_at"), "device_id", "left")


def _with_device_columns(rows: DataFrame, transactions: DataFrame, devices: DataFrame,
                         heavy: DataFrame | None) -> DataFrame:
    facts = _device_facts(transactions, devices)
    age = (micros("timestamp") - micros("first_seen_at")) / DAY_US
    return skew.lookup(rows, facts, "device_id", heavy=heavy).select(
        *rows.columns,
        F.col("transaction_id").eqNullSafe(F.col("__first_transaction")).cast("int")
        .alias("is_new_device"),
        clip(age, lower=0.0).alias("device_age_days"),
    )


def device_features(transactions: DataFrame, devices: DataFrame,
                    limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    heavy = HeavyKeys(transactions, limits, "customer_id", "device_id")
    rows = transactions.select("transaction_id", "customer_id", "device_id", "timestamp")
    aged = _with_device_columns(rows, transactions, devices, heavy["device_id"]).withColumn("__us", micros("timestamp"))
    if heavy["customer_id"] is not None:
        aged = durable(aged)  # read several times below
    wanted = ["customer_device_count_so_far"]
    return _customer_history(aged, wanted, limits, heavy).select(
        "transaction_id", "is_new_device", "device_age_days", *wanted)


# ---------------------------------------------------------------- per merchant

def _history_marks(transactions: DataFrame, ground_truth: DataFrame, stored: bool = False) -> DataFrame:
    """One row per thing that enters history: a transaction, or the confirmation of a fraud.

    ``own`` is 1 on a transaction confirmed by its own instant: that confirmation must not
    count towards its own rate. A confirmation without a transaction has no merchant.
    With ``stored`` the two tables meet once, however often the marks are read.
    """
    frauds = ground_truth.where("fraud_label = 1").select(
        "transaction_id", micros("confirmed_fraud_at").alias("__confirmed"))
    events = transactions.select(
        "transaction_id", "merchant_id", micros("timestamp").alias("__us")
    ).join(frauds, "transaction_id", "full_outer")
    if stored:
        events = durable(events)
    own = F.coalesce((F.col("__confirmed") <= F.col("__us")).cast("int"), F.lit(0))
    marks = F.array(
        F.struct(F.col("__us").alias("at"), F.lit(1).alias("n_txn"), F.lit(0).alias("n_conf"),
                 own.alias("own")),
        F.struct(F.col("__confirmed").alias("at"), F.lit(0).alias("n_txn"),
                 F.lit(1).alias("n_conf"), F.lit(0).alias("own")),
    )
    return events.select(
        "transaction_id", "merchant_id",
        F.inline(F.filter(marks, lambda m: m["at"].isNotNull()))
        .alias("at", "n_txn", "n_conf", "own"))


def _counts_so_far(*partition: str) -> list[Column]:
    """Transactions strictly before the instant, confirmations up to and including it."""
    timeline = W.partitionBy(*partition).orderBy("at")
    return [
        F.coalesce(F.sum("n_txn").over(timeline.rangeBetween(W.unboundedPreceding, -1)),
                   F.lit(0)),
        F.sum("n_conf").over(timeline.rangeBetween(W.unboundedPreceding, 0)),
    ]


def _instants(marks: DataFrame, keys: list[str], limits: Limits) -> DataFrame:
    """The same counts per distinct instant, for groups of any size."""
    collapsed = marks.groupBy(*keys, "at").agg(
        F.sum("n_txn").alias("n_txn"), F.sum("n_conf").alias("n_conf"))
    return running_totals(collapsed, keys, ["at"], ["n_txn", "n_conf"],
                          one_task_rows=limits.one_task_rows).select(
        *keys, "at", F.col("n_txn_before").alias("den"),
        (F.col("n_conf_before") + F.col("n_conf")).alias("num"))


def _with_merchant_counts(marks: DataFrame, heavy: DataFrame | None, limits: Limits) -> DataFrame:
    """marks + ``den`` and ``num`` of their merchant (only meaningful on transactions)."""
    def by_window(df: DataFrame) -> DataFrame:
        den, num = _counts_so_far("merchant_id")
        return df.select("*", den.alias("den"), num.alias("num"))

    if heavy is None:
        return by_window(marks)
    ordinary, large = skew.split(marks, heavy, ["merchant_id"])
    instants = _instants(large, ["merchant_id"], limits)
    counted = large.where("n_txn = 1").join(instants, ["merchant_id", "at"])
    rest = large.where("n_txn = 0").withColumns({"den": F.lit(0), "num": F.lit(0)})
    out = by_window(ordinary)
    return out.unionByName(counted.select(*out.columns)).unionByName(rest.select(*out.columns))


def _with_global_counts(marks: DataFrame, transactions: DataFrame, ground_truth: DataFrame,
                        rows: int, limits: Limits) -> DataFrame:
    """marks of transactions + ``gden`` and ``gnum``: the counts over all merchants."""
    bound = 2 * rows  # a transaction adds at most two marks
    if bound <= limits.one_task_rows:
        den, num = _counts_so_far()
        return marks.select("*", den.alias("gden"), num.alias("gnum")).where("n_txn = 1")
    # Totals per minute come from the two source tables, combined before any shuffle.
    per_minute = durable(
        transactions.groupBy(_minute(micros("timestamp")).alias("minute")).agg(
            F.count("*").alias("txn")).withColumn("conf", F.lit(0).cast("bigint"))
        .unionByName(
            ground_truth.where("fraud_label = 1 and confirmed_fraud_at is not null")
            .groupBy(_minute(micros("confirmed_fraud_at")).alias("minute")).agg(
                F.lit(0).cast("bigint").alias("txn"), F.count("*").alias("conf")))
        .groupBy("minute").agg(F.sum("txn").alias("txn"), F.sum("conf").alias("conf")))
    busiest = per_minute.agg(F.max(F.col("txn") + F.col("conf"))).first()[0] or 0
    if busiest > limits.one_task_rows:
        everyone = _instants(marks, [], limits).select(
            "at", F.col("den").alias("gden"), F.col("num").alias("gnum"))
        return marks.where("n_txn = 1").join(everyone, "at")
    # One row per minute of the calendar the data spans.
    earlier = W.orderBy("minute").rowsBetween(W.unboundedPreceding, -1)
    carry = per_minute.select(
        "minute", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_earlier")
                    for c in ("txn", "conf")])
    den, num = _counts_so_far("minute")
    return (
        marks.withColumn("minute", _minute(F.col("at")))
        .select("*", den.alias("den_inside"), num.alias("num_inside"))
        .where("n_txn = 1").join(carry, "minute")
        .select(*marks.columns,
                (F.col("txn_earlier") + F.col("den_inside")).alias("gden"),
                (F.col("conf_earlier") + F.col("num_inside")).alias("gnum"))
    )


def _minute(us: Column) -> Column:
    return F.floor(us / 60_000_000)


def merchant_features(transactions: DataFrame, ground_truth: DataFrame,
                      min_history: int = MIN_MERCHANT_HISTORY,
                      limits: Limits = DEFAULT_LIMITS,
                      heavy: HeavyKeys | None = None) -> DataFrame:
    """Share of the merchant's earlier transactions confirmed as fraud by then.

    Merchants with fewer than ``min_history`` earlier transactions take the same
    share over all merchants.
    """
    heavy = heavy or HeavyKeys(transactions, limits, "merchant_id")
    marks = _with_merchant_counts(
        _history_marks(transactions, ground_truth, stored=heavy["merchant_id"] is not None),
        heavy["merchant_id"], limits)
    known = F.col("den") >= min_history
    if min_history > 0:
        marks = _with_global_counts(marks, transactions, ground_truth, heavy.rows, limits)
        numerator = F.when(known, F.col("num")).otherwise(F.col("gnum"))
        denominator = F.when(known, F.col("den")).otherwise(F.col("gden"))
    else:
        marks = marks.where("n_txn = 1")
        numerator, denominator = F.col("num"), F.col("den")
    rate = (numerator - F.col("own")) / F.greatest(denominator, F.lit(1))
    return marks.select("transaction_id", clip(rate, 0.0, 1.0).alias("merchant_fraud_rate_hist"))


# ---------------------------------------------------------------- assembled

def feature_table(transactions: DataFrame, customers: DataFrame, devices: DataFrame,
                  ground_truth: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """All six families, one row per transaction, in the declared column order.

    Wide rows move three times: to their device, to their customer (where one
    exchange serves the customer lookup and every customer window), and to their
    transaction id, where the narrow merchant result meets them.
    """
    heavy = HeavyKeys(transactions, limits, "customer_id", "device_id", "merchant_id")
    rows = transactions.select(
        "transaction_id", "customer_id", "merchant_id", "device_id", "timestamp", "amount",
        "payment_method", "country", "ip_country",
    )
    aged = _with_device_columns(rows, transactions, devices, heavy["device_id"])
    homed = skew.lookup(aged, customers.select("customer_id", "home_country"), "customer_id",
                        heavy=heavy["customer_id"])
    if heavy["customer_id"] is not None:
        homed = durable(homed)  # read several times below
    # Made after the rows have moved, not moved with them.
    history = _customer_history(homed.withColumn("__us", micros("timestamp")), [
        "amount_vs_customer_p95", "txn_count_1h", "txn_count_24h",
        "customer_device_count_so_far", "is_new_country_for_customer",
    ], limits, heavy)
    merchant = merchant_features(transactions, ground_truth, limits=limits, heavy=heavy)
    by_row = transaction_columns()
    narrow = history.select(
        *[c for c in history.columns if c in FEATURE_COLUMNS], by_row.pop("is_cross_border").alias("is_cross_border"),
        differs("country", "ip_country").alias("ip_country_mismatch"))
    return narrow.join(merchant, "transaction_id", "left").select(
        "*", *[c.alias(n) for n, c in by_row.items()]).select(*FEATURE_COLUMNS)
