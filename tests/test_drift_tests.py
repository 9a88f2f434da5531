"""Drift tests per column against plain formulas and enumeration."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pytest

from riskloom.operators import drift_tests as dt


def frame(spark, columns):
    rows = list(zip(*columns.values()))
    kinds = ", ".join(f"{c} {'string' if any(isinstance(v, str) for v in vs) else 'double'}" for c, vs in columns.items())
    return spark.createDataFrame([tuple(float(v) if isinstance(v, (int, float)) else v for v in r) for r in rows], kinds)


def judged(spark, a, b, **settings):
    numeric = [c for c, v in a.items() if not any(isinstance(x, str) for x in v)]
    out = dt.column_tests(frame(spark, a), frame(spark, b), numeric, [c for c in a if c not in numeric], **settings)
    return {r.column: r for r in out.collect()}


def largest_gap(a, b):
    """n * m times the largest gap of the samples' shares."""
    a, b = np.sort(a), np.sort(b)
    at = np.concatenate([a, b])
    return int(np.abs(np.searchsorted(a, at, "right") * len(b) - np.searchsorted(b, at, "right") * len(a)).max())


def test_exact_ks_counts_all_orders():
    for n, m in ((3, 4), (5, 5), (2, 7), (6, 3)):
        gaps = []
        for places in combinations(range(n + m), n):
            x = np.array(places)
            gaps.append(largest_gap(x, np.setdiff1d(np.arange(n + m), x)))
        for gap in set(gaps):
            assert dt.ks_p(gap, n, m) == pytest.approx(np.mean([g >= gap for g in gaps]))
    assert dt.ks_p(0, 5, 5) == 1.0 and dt.ks_p(25, 5, 5) == pytest.approx(2 / math.comb(10, 5))


def test_limit_of_ks_meets_the_exact_count(monkeypatch):
    n, m = 900, 1000
    exact = [dt.ks_p(int(d * n * m), n, m) for d in (0.03, 0.05, 0.08)]
    monkeypatch.setattr(dt, "EXACT_CELLS", 0)
    assert [dt.ks_p(int(d * n * m), n, m) for d in (0.03, 0.05, 0.08)] == pytest.approx(exact, abs=0.02)


@pytest.mark.parametrize("freedom", [1, 2, 3, 4, 7, 10])
def test_chi_square_tail_is_the_integral_of_its_density(freedom):
    for x in (0.0, 0.5, 3.0, 12.0):
        t = np.linspace(0, math.sqrt(x), 200_001)  # density of the square root, which is bounded
        density = 2 * t ** (freedom - 1) * np.exp(-t * t / 2) / (2 ** (freedom / 2) * math.gamma(freedom / 2))
        assert dt.chi_square_p(x, freedom) == pytest.approx(1 - np.trapezoid(density, t), abs=1e-8)
    assert dt.chi_square_p(math.inf, freedom) == 0.0 and dt.chi_square_p(3.0, 0) == 1.0


@pytest.mark.parametrize("limits", [{}, {"one_task_rows": 0}], ids=["one task", "blocks"])
def test_choice_and_statistics(spark, limits):
    rng = np.random.default_rng(1)
    a = {"x": rng.normal(size=300), "flag": rng.integers(0, 2, 300), "few": rng.integers(0, 4, 300),
         "kind": rng.choice(list("abc"), 300), "pair": rng.choice(list("uv"), 300, p=[0.5, 0.5])}
    b = {"x": rng.normal(0.5, 1, 200), "flag": rng.integers(0, 2, 200), "few": rng.integers(0, 4, 200),
         "kind": rng.choice(list("abc"), 200), "pair": rng.choice(list("uv"), 200, p=[0.9, 0.1])}
    a, b = ({c: v.tolist() for c, v in side.items()} for side in (a, b))
    got = judged(spark, a, b, **limits)
    assert {c: r.method for c, r in got.items()} == {
        "x": "kolmogorov_smirnov", "flag": "proportions_z", "few": "chi_square", "kind": "chi_square", "pair": "proportions_z"}
    gap = largest_gap(np.array(a["x"]), np.array(b["x"]))
    assert got["x"].statistic == pytest.approx(gap / 60_000) and got["x"].p_value == pytest.approx(dt.ks_p(gap, 300, 200))
    for c in ("few", "kind"):
        values = sorted(set(a[c]))
        ref, cur = (np.array([side[c].count(v) for v in values]) for side in (a, b))
        want = ((cur - ref / 1.5) ** 2 / (ref / 1.5)).sum()
        assert got[c].statistic == pytest.approx(want) and got[c].p_value == pytest.approx(dt.chi_square_p(want, len(values) - 1))
    for c, value in (("flag", 1), ("pair", "v")):
        p, q = np.mean([v == value for v in a[c]]), np.mean([v == value for v in b[c]])
        pooled = (300 * p + 200 * q) / 500
        z = (p - q) / math.sqrt(pooled * (1 - pooled) * (1 / 300 + 1 / 200))
        assert got[c].statistic == pytest.approx(z) and got[c].p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    assert got["x"].drifted and got["pair"].drifted and got["x"].p_value < 0.05
    large = judged(spark, a, b, small=100, **limits)
    assert {c: r.method for c, r in large.items()} == {c: "wasserstein" if c == "x" else "jensen_shannon" for c in a}
    assert all(r.p_value is None for r in large.values()) and large["x"].drifted


def test_empty_sides_new_values_and_missing_ones(spark):
    a = {"x": [1, 2, 3, 4, 5, 6, None], "kind": ["a", "b", "c", "a", None, "b", "c"]}
    b = {"x": [1, 2, 3, 4, 5, 6, 7], "kind": ["a", "b", "new", "a", "b", "c", "c"]}
    got = judged(spark, a, b)
    assert math.isinf(got["kind"].statistic) and got["kind"].p_value == 0.0 and got["kind"].drifted
    assert got["x"].statistic == pytest.approx(1 / 7) and not got["x"].drifted
    whole, none = frame(spark, b), frame(spark, b).limit(0)
    for ref, cur in ((whole, none), (none, whole)):
        out = dt.column_tests(ref, cur, ["x"], ["kind"]).collect()
        assert [(r.statistic, r.p_value, r.drifted) for r in out] == [(0.0, 1.0, False)] * 2
        summary = dt.tests_summary(dt.column_tests(ref, cur, ["x"], ["kind"]), cur).first()
        assert tuple(summary) == (cur.count(), 0, 0.0)
    assert dt.column_tests(none, none, ["x"], ["kind"]).collect() == []
    same = judged(spark, {"x": [2.0] * 5, "kind": ["k"] * 5}, {"x": [2.0] * 4, "kind": ["k"] * 4})
    assert all(r.method == "proportions_z" and r.p_value == 1.0 and not r.drifted for r in same.values())
    with pytest.raises(ValueError, match="unknown mode"):
        dt.column_tests(whole, whole, ["x"], [], mode="other")
