from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import features as f
from riskloom.operators import quality
from riskloom.schemas import FEATURE_COLUMNS, FEATURES
from util import at, by_id, transactions, truth

# Sends every customer through the plan for long ones.
GROUP_ALL = f.Limits(window_rows=0)
# Sends every customer, device and merchant through the plans for heavy keys.
SPLIT_ALL = f.Limits(window_rows=0, customer_rows=0, device_rows=0, merchant_rows=0, quantile_block_rows=4,
                     one_task_rows=0)
BOTH = pytest.mark.parametrize("limits", [f.DEFAULT_LIMITS, GROUP_ALL, SPLIT_ALL],
                               ids=["window", "group", "split"])


@BOTH
def test_trailing_counts_exclude_now_and_include_the_left_edge(spark, limits):
    rows = transactions(spark, [
        dict(transaction_id="A0", customer_id="A", timestamp=at(minutes=0)),
        dict(transaction_id="B0", customer_id="B", timestamp=at(minutes=15)),
        dict(transaction_id="A1", customer_id="A", timestamp=at(minutes=30)),
        dict(transaction_id="B1", customer_id="B", timestamp=at(minutes=45)),
        dict(transaction_id="A2", customer_id="A", timestamp=at(minutes=90)),
        dict(transaction_id="B2", customer_id="B", timestamp=at(minutes=120)),
    ])
    got = by_id(f.velocity_features(rows, limits))
    assert [got[k].txn_count_1h for k in ("A0", "A1", "A2", "B0", "B1", "B2")] == [0, 1, 1, 0, 1, 0]
    assert [got[k].txn_count_24h for k in ("A0", "A1", "A2", "B0", "B1", "B2")] == [0, 1, 2, 0, 1, 2]


@BOTH
def test_trailing_counts_leave_out_the_same_instant(spark, limits):
    rows = transactions(spark, [dict(timestamp=at()), dict(timestamp=at()),
                                dict(timestamp=at(minutes=1))])
    got = by_id(f.velocity_features(rows, limits))
    assert [got[k].txn_count_1h for k in ("T0", "T1", "T2")] == [0, 0, 2]


@BOTH
def test_amount_ratio_needs_five_earlier_rows(spark, limits):
    rows = transactions(spark, [dict(amount=10.0)] * 5 + [dict(amount=100.0)])
    got = by_id(f.behavioral_features(rows, limits))
    assert [got[f"T{i}"].amount_vs_customer_p95 for i in range(5)] == [1.0] * 5
    assert got["T5"].amount_vs_customer_p95 == pytest.approx(10.0, abs=1e-4)


@BOTH
def test_device_novelty_age_and_count(spark, limits):
    rows = transactions(spark, [dict(device_id="D1"), dict(device_id="D1"), dict(device_id="D2")])
    devices = spark.createDataFrame([("D1", at()), ("D2", at(hours=3))],
                                    "device_id string, first_seen_at timestamp_ntz")
    got = by_id(f.device_features(rows, devices, limits))
    assert [got[f"T{i}"].is_new_device for i in range(3)] == [1, 0, 1]
    assert [got[f"T{i}"].customer_device_count_so_far for i in range(3)] == [0, 1, 1]
    assert got["T1"].device_age_days == pytest.approx(1 / 24)
    assert got["T2"].device_age_days == 0.0  # seen before it was registered


@BOTH
def test_geo_novelty_and_mismatch(spark, limits):
    rows = transactions(spark, [
        dict(country="US", ip_country="US"), dict(country="US", ip_country="GB"),
        dict(country="GB", ip_country="GB"), dict(country="GB", ip_country=None)])
    got = by_id(f.geo_features(rows, limits))
    assert [got[f"T{i}"].is_new_country_for_customer for i in range(4)] == [1, 0, 1, 0]
    assert [got[f"T{i}"].ip_country_mismatch for i in range(4)] == [0, 1, 0, 1]


@BOTH
def test_transaction_columns_and_unknown_customer(spark, limits):
    rows = transactions(spark, [
        dict(timestamp=at(hours=2)), dict(timestamp=at(hours=14)),
        dict(timestamp=at(hours=14, minutes=30), country="GB"), dict(customer_id="nobody")])
    customers = spark.createDataFrame([("C1", "US")], "customer_id string, home_country string")
    got = by_id(f.transaction_features(rows, customers, limits))
    assert (got["T0"].hour_of_day, got["T0"].is_night) == (2, 1)
    assert got["T1"].is_night == 0
    assert [got[f"T{i}"].is_cross_border for i in range(4)] == [0, 0, 1, 1]


@BOTH
def test_merchant_rate_waits_for_the_confirmation(spark, limits):
    rows = transactions(spark, [
        dict(transaction_id="A", timestamp=at()), dict(transaction_id="B", timestamp=at(days=5)),
        dict(transaction_id="C", timestamp=at(days=15))])
    labels = truth(spark, [("A", 1, at(days=10)), ("B", 0, None), ("C", 0, None)])
    got = by_id(f.merchant_features(rows, labels, min_history=0, limits=limits))
    assert [got[k].merchant_fraud_rate_hist for k in "ABC"] == [0.0, 0.0, 0.5]


@BOTH
def test_young_merchant_takes_the_rate_of_all(spark, limits):
    rows = transactions(spark, [
        dict(transaction_id=k, merchant_id="M1" if k == "A" else "M2", timestamp=at(days=i))
        for i, k in enumerate("ABCD")])
    labels = truth(spark, [("A", 1, at(hours=1))] + [(k, 0, None) for k in "BCD"])
    got = by_id(f.merchant_features(rows, labels, limits=limits))
    assert got["D"].merchant_fraud_rate_hist == pytest.approx(1 / 3)


@BOTH
def test_own_confirmation_does_not_count(spark, limits):
    rows = transactions(spark, [
        dict(transaction_id="X", timestamp=at()), dict(transaction_id="Y", timestamp=at(days=5)),
        dict(transaction_id="Z", timestamp=at(days=10))])
    labels = truth(spark, [("X", 1, at()), ("Y", 0, None), ("Z", 0, None)])
    got = by_id(f.merchant_features(rows, labels, min_history=0, limits=limits))
    assert [got[k].merchant_fraud_rate_hist for k in "XYZ"] == [0.0, 1.0, 0.5]


def test_feature_table_is_valid_complete_and_repeatable(small):
    built = small.features
    assert built.columns == FEATURE_COLUMNS
    assert [x.dataType for x in built.schema] == [x.dataType for x in FEATURES]
    assert quality.require_valid(built, "features") is built
    assert quality.leaking_columns(built, quality.FORBIDDEN_COLUMNS) == []
    left = quality.one_to_one(built, small.transactions(), "transaction_id").first()
    assert tuple(left) == (0, 0, 0)
    again = small.build_features()
    assert built.exceptAll(again).count() == 0 and again.exceptAll(built).count() == 0


def test_heavy_plans_agree_with_windows_on_real_rows(small):
    rows = small.transactions()
    limits = f.Limits(window_rows=55, customer_rows=65, device_rows=20, merchant_rows=8, quantile_block_rows=16,
                      one_task_rows=50)
    split = f.feature_table(rows, small.customers(), small.devices(), small.ground_truth(), limits)

    def tidy(df):
        return df.withColumn("amount_vs_customer_p95", F.round("amount_vs_customer_p95", 9))

    assert tidy(split).exceptAll(tidy(small.features)).count() == 0
    assert tidy(small.features).exceptAll(tidy(split)).count() == 0


def test_heavy_plans_agree_with_windows_on_ties(spark, small):
    from riskloom.plans.queries import _orders_as_transactions

    rows = _orders_as_transactions(small).withColumn("customer_id", F.expr("customer_id % 3"))
    rows = rows.withColumn("customer_id", F.col("customer_id").cast("string"))
    plans = [f.Limits(customer_rows=400, quantile_block_rows=37, one_task_rows=100), GROUP_ALL]
    for build in (f.velocity_features, f.behavioral_features):
        def values(limits):
            out = build(rows, limits)
            return out.select("transaction_id", *[
                F.round(c, 9).alias(c) for c in out.columns if c != "transaction_id"])

        a = values(f.Limits(window_rows=10**9))
        for limits in plans:
            b = values(limits)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_global_rate_carries_over_minutes(spark, small):
    """Between the one-task and the range-split plan lies the plan by minute."""
    a = f.merchant_features(small.transactions(), small.ground_truth())
    b = f.merchant_features(small.transactions(), small.ground_truth(),
                            limits=f.Limits(one_task_rows=100))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_confirmation_without_a_transaction_counts_for_all_merchants(spark):
    rows = transactions(spark, [dict(transaction_id=k, timestamp=at(days=i))
                                for i, k in enumerate("ABC")])
    labels = truth(spark, [("gone", 1, at(hours=1))] + [(k, 0, None) for k in "ABC"])
    for limits in (f.DEFAULT_LIMITS, f.Limits(one_task_rows=2), SPLIT_ALL):
        got = by_id(f.merchant_features(rows, labels, limits=limits))
        assert [got[k].merchant_fraud_rate_hist for k in "ABC"] == [0.0, 1.0, 0.5]


def test_customer_windows_share_one_exchange(small):
    plan = f.velocity_features(small.transactions())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("limits", [
    f.DEFAULT_LIMITS, f.Limits(window_rows=2),
    f.Limits(window_rows=2, customer_rows=3, device_rows=3, quantile_block_rows=4, one_task_rows=0),
], ids=["windows", "groups", "split"])
def test_missing_values_mean_the_same_in_every_plan(spark, limits):
    rows = [(f"T{i:02}", "C1", dt.datetime(2024, 1, 1, i), None if i in (2, 6) else float(10 + 7 * i % 31),
             None if i in (0, 4, 9) else "DE" if i < 8 else "FR", None if i in (3, 6) else f"D{i // 5}")
            for i in range(12)]
    frame = spark.createDataFrame(
        [(*r[:3], r[3], r[4], "DE", r[5]) for r in rows],
        "transaction_id string, customer_id string, timestamp timestamp_ntz, amount double, country string,"
        " ip_country string, device_id string")
    ratio = {r[0]: r[1] for r in f.behavioral_features(frame, limits).collect()}
    new = {r[0]: r[1] for r in f.geo_features(frame, limits).collect()}
    past, seen = [], set()
    for name, _, _, amount, country, _ in rows:
        want = 1.0 if amount is None or len(past) < 5 else amount / (np.quantile(past, 0.95) + 1e-6)
        assert ratio[name] == pytest.approx(want)
        assert new[name] == int(country is not None and country not in seen)
        past += [amount] if amount is not None else []
        seen |= {country} - {None}
    devices = spark.createDataFrame([("D0", dt.datetime(2024, 1, 1))], "device_id string, first_seen_at timestamp_ntz")
    used = {r.transaction_id: r.customer_device_count_so_far
            for r in f.device_features(frame, devices, limits).collect()}
    assert [used[r[0]] for r in rows] == [0, 1, 1, 1, 1, 1, 2, 2, 2, 2, 2, 3]


def test_labels_and_scores_move_along_with_the_feature_rows(small):
    """The stored table holds what a join by transaction finds, and neither needs that join again."""
    for rows, joined, extra in (
            (small.split_rows().drop("split"), small.labelled(), ["fraud_label"]),
            (small.scored_features(), small.features.join(small.transactions_plus().select(
                "transaction_id", F.col("event_id").alias("id"), "model_score", "fraud_label"), "transaction_id"),
             ["id", "model_score", "fraud_label"])):
        assert rows.columns == joined.columns and rows.count() == joined.count()
        assert rows.exceptAll(joined.select(rows.columns)).isEmpty()
        assert "Join" not in rows.select("transaction_id", *extra)._jdf.queryExecution().optimizedPlan().toString()


def test_split_customers_read_their_device_columns_once_stored(small):
    """The device lookups are not worked through again for every reader of the split rows."""
    rows = small.transactions()
    out = f.device_features(rows, small.devices(), SPLIT_ALL)
    assert "__first_transaction" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.exceptAll(f.device_features(rows, small.devices())).isEmpty()
    assert out.count() == rows.count()


def test_split_merchants_meet_their_confirmations_once(small):
    """The plan for heavy merchants reads the history several times, but joins it once."""
    out = f.merchant_features(small.transactions(), small.ground_truth(), limits=SPLIT_ALL)
    assert "FullOuter" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.exceptAll(f.merchant_features(small.transactions(), small.ground_truth())).isEmpty()


def test_windows_sort_earlier_amounts_as_plain_numbers(small):
    """The quantile over a customer's earlier amounts is what ``percentile`` gives, without its cost per row."""
    rows = small.transactions()
    out = f.behavioral_features(rows)
    assert "percentile(" not in out._jdf.queryExecution().optimizedPlan().toString()
    before = "over (partition by customer_id order by timestamp, transaction_id rows between unbounded preceding and 1 preceding)"
    known = rows.selectExpr("transaction_id", "amount", f"count(amount) {before} as n", f"percentile(amount, 0.95) {before} as p")
    ratio = known.selectExpr("transaction_id", "case when n >= 5 then amount / (p + 1e-6D) else 1.0D end as amount_vs_customer_p95")
    assert out.count() == rows.count() and out.exceptAll(ratio).isEmpty()
