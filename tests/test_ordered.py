from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskloom.operators import skew
from riskloom.operators.expanding import expanding_quantile, expanding_values, row_positions
from riskloom.operators.ordered import exact_quantiles, running_totals
from util import by_id


@pytest.mark.parametrize("one_task_rows", [10**6, 0], ids=["one task", "blocks"])
def test_running_totals_and_previous_value(spark, one_task_rows):
    rng = np.random.default_rng(1)
    data = [("big" if i % 3 else "small", int(v), int(w))
            for i, (v, w) in enumerate(zip(rng.permutation(900), rng.integers(0, 5, 900)))]
    df = spark.createDataFrame(data, "k string, v int, w int")
    out = running_totals(df, ["k"], ["v"], ["w"], previous="v", one_task_rows=one_task_rows)
    for key in ("big", "small"):
        want, last = 0, None
        for r in sorted((r for r in out.collect() if r.k == key), key=lambda r: r.v):
            assert (r.w_before, r.previous_v) == (want, last)
            want, last = want + r.w, r.v


@pytest.mark.parametrize("one_task_rows", [10**6, 0], ids=["one task", "blocks"])
def test_quantiles_match_numpy(spark, one_task_rows):
    rng = np.random.default_rng(2)
    groups = {"a": rng.integers(0, 30, 500).astype(float), "b": rng.normal(size=301), "c": [4.0]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs],
                               "k string, v double")
    wanted = [0.0, 0.1, 0.5, 0.95, 1.0]
    out = exact_quantiles(df, ["k"], "v", wanted, one_task_rows=one_task_rows)
    rows = {(r.k, r.probability): r.quantile for r in out.collect()}
    assert len(rows) == 15
    for k, vs in groups.items():
        for p in wanted:
            assert rows[k, p] == pytest.approx(np.quantile(vs, p))
    overall = exact_quantiles(df, [], "v", [0.5], one_task_rows=one_task_rows).first().quantile
    assert overall == pytest.approx(np.median(np.concatenate(list(groups.values()))))


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 40), min_size=1, max_size=60), block=st.integers(1, 9),
       q=st.sampled_from([0.0, 0.5, 0.95, 1.0]))
def test_expanding_quantile_is_exact_for_any_block_size(spark, values, block, q):
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(values)],
                               "k string, id int, v double")
    out = expanding_quantile(row_positions(df, ["k"], ["id"]), "k", "id", "v", q, min_prior=1,
                             block_rows=block, salts=3)
    got = {r.id: r.quantile for r in out.collect()}
    assert len(got) == len(values) and got[0] is None
    for i in range(1, len(values)):
        assert got[i] == pytest.approx(np.quantile(values[:i], q))


@given(values=st.lists(st.integers(-20, 20), max_size=80), q=st.floats(0, 1))
def test_heaps_follow_the_quantile(values, q):
    got = expanding_values(np.array(values, dtype=float), q, 1)
    assert len(got) == len(values)
    for i in range(1, len(values)):
        assert got[i] == pytest.approx(np.quantile(values[:i], q), abs=1e-9)


def test_heavy_keys_are_the_largest_and_bounded(spark):
    df = spark.createDataFrame([(k,) for k, n in (("a", 9), ("b", 5), ("c", 7)) for _ in range(n)],
                               "k string")
    assert skew.heavy_keys(df, ["k"], 9) is None
    found = skew.heavy_keys(df, ["k"], 4, max_keys=2)
    assert [(r.k, r.key_rows) for r in found.collect()] == [("a", 9), ("c", 7)]
    assert skew.key_profile(df, ["k"]) == {"k": (21, 9)}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_keeps_rows_of_heavy_unknown_and_missing_keys(spark, how):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["h"] * 5 + ["o", "x", None])],
                                 "transaction_id int, k string")
    dim = spark.createDataFrame([("h", 1), ("o", 2)], "k string, v int")
    plain = by_id(skew.lookup(rows, dim, "k", how))
    split = by_id(skew.lookup(rows, dim, "k", how, heavy=skew.heavy_keys(rows, ["k"], 2)))
    assert split == plain and len(plain) == (8 if how == "left" else 6)


def test_small_groups_share_a_batch_and_none_is_parted():
    import pandas as pd

    from riskloom.operators.expanding import whole_groups

    sizes = [1, 4, 2, 7, 1, 1, 3]
    keys = [None, *"abcdef"]
    rows = pd.DataFrame({"k": [k for k, n in zip(keys, sizes) for _ in range(n)], "x": range(sum(sizes))})
    for step in (1, 2, 3, 5, 100):
        batches = (rows.iloc[i:i + step] for i in range(0, len(rows), step))
        got = [(part, edges) for part, edges in whole_groups(batches, ["k"])]
        assert pd.concat([part for part, _ in got])["x"].tolist() == rows["x"].tolist()
        assert [int(n) for _, edges in got for n in np.diff(edges)] == sizes
    assert len(got) == 2 and not list(whole_groups(iter([]), ["k"]))


def test_long_customers_need_no_call_each(spark):
    from riskloom.operators import features

    rows = spark.range(0, 900, 1, 4).selectExpr(
        "concat('T', id) transaction_id", "if(id % 10 = 9, null, concat('C', id % 10)) customer_id",
        "timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, cast(id % 83 as int) * 17) timestamp",
        "if(id % 7 = 0, null, id % 31 * 1.5) amount", "if(id % 11 = 0, null, concat('X', id % 4)) country",
        "'US' ip_country", "if(id % 13 = 0, null, concat('D', id % 5)) device_id")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for family in (features.velocity_features, features.behavioral_features, features.geo_features):
            windows, groups = (
                sorted((r[0], *(round(v, 9) for v in r[1:])) for r in family(rows, limits).collect())
                for limits in (features.DEFAULT_LIMITS, features.Limits(window_rows=2)))
            assert windows == groups and len(groups) == 900
        plan = features.behavioral_features(rows, features.Limits(window_rows=2))._jdf.queryExecution().toString()
        assert "FlatMapGroupsInPandas" not in plan
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
