from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.operators import policy

ROW = dict(is_new_device=0, is_new_country_for_customer=0, ip_country_mismatch=0, txn_count_1h=0,
           merchant_fraud_rate_hist=0.0, amount_vs_customer_p95=1.0, customer_id="C1",
           merchant_id="M1", model_score=0.1)
SCHEMA = ("is_new_device int, is_new_country_for_customer int, ip_country_mismatch int,"
          " txn_count_1h bigint, merchant_fraud_rate_hist double, amount_vs_customer_p95 double,"
          " customer_id string, merchant_id string, model_score double")
TAKEOVER = dict(is_new_device=1, is_new_country_for_customer=1, ip_country_mismatch=1)

# overrides, rules fired, rule level, decision, source
CASES = [
    ({}, [], "approve", "approve", "model"),
    (TAKEOVER, ["device_location_takeover"], "block", "block", "rule"),
    (dict(TAKEOVER, ip_country_mismatch=0), [], "approve", "approve", "model"),
    (dict(txn_count_1h=5), ["velocity_spike"], "block", "block", "rule"),
    (dict(txn_count_1h=4), [], "approve", "approve", "model"),
    (dict(merchant_fraud_rate_hist=0.16), ["high_risk_merchant"], "review", "review", "rule"),
    (dict(merchant_fraud_rate_hist=0.15), [], "approve", "approve", "model"),
    (dict(amount_vs_customer_p95=3.1, is_new_device=1), ["outsized_amount_new_device"], "review",
     "review", "rule"),
    (dict(amount_vs_customer_p95=3.1), [], "approve", "approve", "model"),
    (dict(merchant_fraud_rate_hist=0.2, model_score=0.9), ["high_risk_merchant"], "review",
     "block", "model"),
    (dict(merchant_fraud_rate_hist=0.2, model_score=0.5), ["high_risk_merchant"], "review",
     "review", "rule"),  # equal levels: the rule is named
    (dict(model_score=0.7), [], "approve", "block", "model"),
    (dict(model_score=0.3), [], "approve", "review", "model"),
    (dict(TAKEOVER, txn_count_1h=9, customer_id="VIP", model_score=0.9),
     ["device_location_takeover", "velocity_spike", "trusted_allowlist"], "block", "approve",
     "rule_override"),
    (dict(merchant_id="SAFE"), ["trusted_allowlist"], "approve", "approve", "rule_override"),
]


def _rows(spark):
    return spark.createDataFrame([(i, *{**ROW, **c[0]}.values()) for i, c in enumerate(CASES)],
                                 "i int, " + SCHEMA)


def test_rules_and_combination(spark):
    ruled = rules.evaluate_rules(_rows(spark), ["VIP"], ["SAFE"])
    got = {r.i: r for r in rules.decide(ruled, 0.3, 0.7).collect()}
    for i, (_, fired, level, decision, source) in enumerate(CASES):
        r = got[i]
        assert (r.triggered_rules, r.rule_decision, r.decision, r.decision_source) == (
            fired, level, decision, source), CASES[i]


def test_allowlist_tables_match_allowlist_lists(spark):
    rows = _rows(spark)
    marked = rules.mark_allowlisted(
        rows, spark.createDataFrame([("VIP",), ("VIP",)], "customer_id string"),
        spark.createDataFrame([("SAFE",)], "merchant_id string"))
    a = rules.evaluate_rules(marked).select("i", "is_allowlisted", "triggered_rules")
    b = rules.evaluate_rules(rows, ["VIP"], ["SAFE"]).select("i", "is_allowlisted", "triggered_rules")
    assert sorted(a.collect()) == sorted(b.collect())


def _scored(spark, scores, labels, amounts):
    return spark.createDataFrame(
        [(float(s), int(y), float(a)) for s, y, a in zip(scores, labels, amounts)],
        "model_score double, fraud_label int, amount double")


def _cost(s, y, a, t_review, t_block):
    s, y, a = np.asarray(s), np.asarray(y), np.asarray(a)
    return (a[(s < t_review) & (y == 1)].sum() + 3.5 * ((s >= t_review) & (s < t_block)).sum()
            + 25 * ((s >= t_block) & (y == 0)).sum())


def test_policy_costs_by_outcome(spark):
    rows = _scored(spark, [.02, .35, .35, .74, .74, .91], [1, 0, 1, 0, 1, 0], [12.5, 3, 70, 8, 41, 6])
    low, middle, high = (policy.total_cost(rows, *t).first() for t in ((.3, .7), (.5, .8), (.95, .99)))
    # Missed below the first threshold, reviewed up to the second, blocked from there on.
    assert (low.missed_fraud, low.review_cost, low.false_positive_cost) == (12.5, 7.0, 50.0)
    assert (middle.missed_fraud, middle.review_cost, middle.false_positive_cost) == (82.5, 7.0, 25.0)
    assert high.total_cost == high.missed_fraud == 123.5


def test_grid_prefers_reviewing_to_missing(spark):
    # Reviewing the two scores at 0.4 costs 7, missing the fraud among them 30.
    rows = _scored(spark, [.1, .4, .4, .8], [0, 0, 1, 1], [9, 9, 30, 200])
    best = policy.best_thresholds(rows, step=0.1).first()
    assert best.total_cost == 7.0 and .1 < best.t_review <= .4 < best.t_block <= .8


@pytest.mark.parametrize("seed", [1, 2])
def test_grid_equals_brute_force_also_on_edges(spark, seed):
    rng = np.random.default_rng(seed)
    # Scores on, just below and between grid edges, and beyond both ends.
    s = np.concatenate([rng.integers(0, 101, 150) * 0.01, np.round(rng.random(50), 2), [-0.1, 1.2],
                        np.nextafter(rng.integers(1, 101, 30) * 0.01, 0)])
    y = (rng.random(len(s)) < 0.2).astype(int)
    a = np.round(rng.random(len(s)) * 200, 2)
    grid = [i * 0.01 for i in range(policy.grid_size(0.01))]
    best = (np.inf, 0, 0)
    for i, lo in enumerate(grid):
        for j, hi in enumerate(grid):
            if hi > lo:
                best = min(best, (round(_cost(s, y, a, lo, hi), 6), i, j))
    got = policy.best_thresholds(_scored(spark, s, y, a)).first()
    assert (got.total_cost, got.t_review, got.t_block) == (
        pytest.approx(best[0]), round(grid[best[1]], 4), round(grid[best[2]], 4))
    t_block = round(grid[best[2]], 4)
    curve = {r.t_review: r.cost for r in policy.cost_curve(_scored(spark, s, y, a)).collect()}
    want = {round(c, 4): _cost(s, y, a, c, t_block) for c in grid if c < t_block}
    assert curve.keys() == want.keys()
    assert all(curve[t] == pytest.approx(want[t]) for t in want)


def test_curve_lookup(spark):
    curve = spark.createDataFrame([(0.0, 100.0), (0.2, 80.0), (0.1, 50.0)], "t_review double, cost double")
    asked = spark.createDataFrame([(0.1,), (0.05,), (-0.5,), (1.5,), (0.15,)], "t double")
    got = {r.t: r.cost for r in policy.cost_at(asked, curve).collect()}
    assert got == {0.1: 50.0, 0.05: 75.0, -0.5: 100.0, 1.5: 80.0, 0.15: pytest.approx(65.0)}
    empty = policy.cost_at(asked, curve.where(F.lit(False)))
    assert {r.cost for r in empty.collect()} == {0.0}


def test_policy_document_is_nested(spark):
    rows = _scored(spark, [.05, .95], [0, 1], [10, 500])
    doc = policy.policy_document(rows, "r1", step=0.1).first()
    assert doc.model_run_id == "r1" and doc.cost_matrix["review_cost"] == "3.50"
    assert [p.t_review for p in doc.cost_curve] == sorted(p.t_review for p in doc.cost_curve)
    assert doc.cost_curve[-1].t_review < doc.t_block
