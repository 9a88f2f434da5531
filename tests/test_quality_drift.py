from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import drift, quality
from util import at

GOOD = dict(transaction_id="TXN1", customer_id="CUST1", merchant_id="MERC1", timestamp=at(),
            amount=5.0, payment_method="card", hour_of_day=3, is_night=1, is_cross_border=0,
            amount_vs_customer_p95=1.0, txn_count_1h=0, txn_count_24h=0, is_new_device=1,
            device_age_days=0.0, customer_device_count_so_far=0, merchant_fraud_rate_hist=0.0,
            is_new_country_for_customer=1, ip_country_mismatch=0)


def feature_rows(spark, *overrides):
    return spark.createDataFrame([tuple({**GOOD, **o}.values()) for o in overrides], S.FEATURES)


def failures(report):
    return {(r.column, r.check): r.failures for r in report.where("failures > 0").collect()}


def test_valid_row_passes_and_extra_column_fails(spark):
    good = feature_rows(spark, {})
    assert failures(quality.validate(good, "features")) == {}
    leaky = good.withColumn("fraud_label", F.lit(1))
    assert failures(quality.validate(leaky, "features")) == {("fraud_label", "column_in_schema"): 1}
    with pytest.raises(quality.QualityError, match="fraud_label"):
        quality.require_valid(leaky, "features")
    missing = good.drop("amount").withColumn("is_night", F.col("is_night").cast("bigint"))
    assert failures(quality.validate(missing, "features")) == {
        ("amount", "column_in_dataframe"): 1, ("is_night", "dtype('int')"): 1}


def test_every_violation_is_counted(spark):
    rows = feature_rows(
        spark, dict(amount=-1.0), dict(transaction_id="X", hour_of_day=24),
        dict(payment_method="cash", is_night=2), dict(amount=None),
        dict(merchant_fraud_rate_hist=1.5, txn_count_1h=-1))
    assert failures(quality.validate(rows, "features")) == {
        ("amount", "greater_than(0)"): 1, ("amount", "not_nullable"): 1,
        ("transaction_id", "str_startswith('TXN')"): 1, ("hour_of_day", "in_range(0, 23)"): 1,
        ("payment_method", f"isin({S.PAYMENT_METHODS})"): 1, ("is_night", "isin([0, 1])"): 1,
        ("merchant_fraud_rate_hist", "in_range(0, 1)"): 1,
        ("txn_count_1h", "greater_than_or_equal_to(0)"): 1,
        ("transaction_id", "field_uniqueness"): 4}
    cells = quality.failure_cases(rows, quality.expectations("features"), "transaction_id")
    assert ("amount", "greater_than(0)", "-1.0") in {tuple(r)[1:] for r in cells.collect()}
    assert cells.count() == 8


def test_nullable_confirmation_is_allowed(spark):
    rows = spark.createDataFrame([("TXN1", 0.2, 0, None)], S.GROUND_TRUTH)
    assert failures(quality.validate(rows, "ground_truth")) == {}


def _log(spark, *payloads):
    rows = [(i, p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        [(i, tuple({**GOOD, **p}.values()) if p is not None else None) for i, p in rows],
        "id bigint, feature_row " + S.FEATURES.simpleString())


def test_scored_rows_may_repeat_but_not_break_checks(spark):
    assert tuple(quality.scored_summary(_log(spark, {}, {}, None)).first()) == (2, True, 0)
    assert tuple(quality.scored_summary(_log(spark, dict(amount=-1.0), {})).first()) == (2, False, 1)
    newest = quality.scored_summary(_log(spark, dict(amount=-1.0), {}), limit=1).first()
    assert tuple(newest) == (1, True, 0)
    assert tuple(quality.scored_summary(_log(spark, {}).where("id < 0")).first()) == (0, True, 0)


def test_references_and_one_to_one(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("x",), ("z",)], "k string")
    assert sorted(str(r.k) for r in quality.orphans(a, b, "k").collect()) == ["None", "y"]
    assert {r.k for r in quality.missing_keys(a, b, "k").collect()} == {"y", None}
    assert tuple(quality.one_to_one(a.na.drop(), b, "k").first()) == (1, 1, 1)


def _features(spark, n, seed, shift=0.0, method="card"):
    rng = np.random.default_rng(seed)
    return feature_rows(spark, *[
        dict(amount=float(round(rng.gamma(2, 20) + shift, 1)), device_age_days=float(i % 7),
             payment_method=method if i % 4 else "wallet") for i in range(n)])


def _w1(a, b):
    values = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), values[:-1], side="right") / len(a)
    fb = np.searchsorted(np.sort(b), values[:-1], side="right") / len(b)
    return float(np.sum(np.abs(fa - fb) * np.diff(values))), float(np.max(np.abs(fa - fb)))


@pytest.mark.parametrize("one_task_rows", [10**6, 0], ids=["one task", "blocks"])
def test_numeric_distances_match_numpy(spark, one_task_rows):
    a, b = _features(spark, 120, 1), _features(spark, 50, 2, shift=5.0)
    got = {r.column: r for r in drift.numeric_distances(
        a, b, ["amount", "device_age_days", "is_night"], one_task_rows=one_task_rows).collect()}
    for c in ("amount", "device_age_days"):
        x, y = (np.array([r[0] for r in d.select(c).collect()]) for d in (a, b))
        area, ks = _w1(x, y)
        assert got[c].wasserstein == pytest.approx(area / x.std())
        assert got[c].ks == pytest.approx(ks)
    assert got["is_night"].wasserstein == 0 and got["is_night"].ks == 0


def test_drift_report_and_empty_current(spark):
    a, b = _features(spark, 100, 1), _features(spark, 50, 2, shift=80.0, method="bank_transfer")
    report = drift.drift_report(a, b)
    marks = {r.column: r.drifted for r in report.collect()}
    assert marks["amount"] and marks["payment_method"] and not marks["is_night"]
    assert len(marks) == len(S.MODEL_INPUTS) == 14
    summary = drift.drift_summary(report, b).first()
    assert summary.checked_rows == 50 and summary.drifted_columns_count == 2
    empty = b.where("amount < 0")
    none = drift.drift_summary(drift.drift_report(a, empty), empty).first()
    assert tuple(none) == (0, 0, 0.0)
    same = drift.categorical_distance(a, a, "payment_method").first().js
    assert same == pytest.approx(0.0)
    apart = drift.categorical_distance(
        a.withColumn("p", F.lit("x")), a.withColumn("p", F.lit("y")), "p").first().js
    assert apart == pytest.approx(np.sqrt(np.log(2)))


def test_drift_far_from_zero_and_with_missing_categories(spark):
    a = spark.createDataFrame([(1e9 + i % 2,) for i in range(50)], "amount double")
    b = a.select((F.col("amount") + 1).alias("amount"))
    assert drift.numeric_distances(a, b, ["amount"]).first().wasserstein == pytest.approx(2.0)
    half = spark.createDataFrame([(None if i % 2 else "card",) for i in range(20)], "payment_method string")
    assert drift.categorical_distance(half, half, "payment_method").first().js == pytest.approx(0.0)


def test_nan_is_missing(spark):
    rows = spark.createDataFrame([(float("nan"),), (None,), (-1.0,), (2.0,)], "amount double")
    checks = [quality._not_null("amount", True), quality._above("amount", 0), quality._between("amount", 0, 1)]
    got = {r["check"]: r["failures"] for r in quality.column_checks(rows, checks).collect()}
    assert got == {"not_nullable": 2, "greater_than(0)": 1, "in_range(0, 1)": 2}


def test_orphans_of_many_references_in_one_grouping(spark):
    left = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c"), (3, "a")], "k int, s string")
    right = spark.createDataFrame([(1, "a"), (None, "z")], "id bigint, name string")
    tables = {"left": left, "right": right, "none": left.limit(0)}
    references = [("k", "left", "k", "right", "id"), ("s", "left", "s", "right", "name"), ("back", "right", "id", "left", "k"),
                  ("all", "left", "k", "none", "k"), ("empty", "none", "k", "right", "id")]
    got = {r.reference: r.orphans for r in quality.orphan_counts(tables, references).collect()}
    assert got == {"k": 3, "s": 3, "back": 1, "all": 5, "empty": 0}
    for name, child, column, parent, key in references:
        rows = tables[child].select(F.col(column).cast("string").alias("key"))
        assert got[name] == quality.orphans(rows, tables[parent].select(F.col(key).cast("string").alias("key")), "key").count()
