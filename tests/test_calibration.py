"""Isotonic calibration against plain pooling and Spark's own fit."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from riskloom.operators.calibration import IsotonicMap, isotonic_blocks, pool


def plain(value, label):
    """Blocks of the isotonic fit: (low, high, mean)."""
    blocks = []
    for v in np.unique(value):
        own = label[value == v]
        blocks.append([v, v, own.sum(), len(own)])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([a[0], b[1], a[2] + b[2], a[3] + b[3]])
    return [(low, high, s / n) for low, high, s, n in blocks]


def points(spark, value, label):
    return spark.createDataFrame([(float(v), int(y)) for v, y in zip(value, label)], "value double, label int")


def shapes():
    rng = np.random.default_rng(1)
    x = rng.random(400)
    yield x, (rng.random(400) < x).astype(int)
    yield x, (rng.random(400) < 1 - x).astype(int)  # everything is one block
    yield np.round(x, 1), (rng.random(400) < x).astype(int)
    yield x, np.zeros(400, int)
    wave = np.arange(300) / 300
    yield wave, (rng.random(300) < 0.5 + 0.4 * np.sin(12 * wave)).astype(int)
    yield wave, (wave > 0.5).astype(int)


@pytest.mark.parametrize("shape", range(6))
@pytest.mark.parametrize("range_rows", [5, 1000])
def test_blocks_equal_plain_pooling(spark, shape, range_rows):
    value, label = list(shapes())[shape]
    got = isotonic_blocks(points(spark, value, label), range_rows=range_rows).orderBy("low").collect()
    want = plain(value, label)
    assert [(r.low, r.high) for r in got] == [w[:2] for w in want]
    assert [r.total / r.weight for r in got] == pytest.approx([w[2] for w in want])


def test_map_equals_sparks_own_fit(spark):
    value, label = next(shapes())
    rows = points(spark, value, label)
    own = IsotonicMap.fit(rows, range_rows=20)
    theirs = IsotonicRegression(featuresCol="value", labelCol="label", predictionCol="theirs").fit(rows)
    asked = spark.createDataFrame([(float(v),) for v in [-1, 0, 2, *value[:50], *np.linspace(0, 1, 77)]], "value double")
    for r in theirs.transform(own.apply(asked, "value", "ours")).collect():
        assert r.ours == pytest.approx(r.theirs)


def test_missing_values_empty_tables_and_storage(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), (0.5, None), (float("nan"), 1), (0.2, 0), (0.7, 1)], "value double, label int")
    fitted = IsotonicMap.fit(rows)
    fitted.save(spark, str(tmp_path / "map"))
    again = IsotonicMap.load(spark, str(tmp_path / "map"))
    assert again.knots.tolist() == [0.2, 0.7] and again.values.tolist() == [0.0, 1.0]
    got = [r.p for r in again.apply(rows, "value", "p").collect()]
    assert got == [None, pytest.approx(0.6), None, 0.0, 1.0]
    empty = IsotonicMap.fit(rows.limit(0))
    assert [r.p for r in empty.apply(rows, "value", "p").collect()] == [None] * 5


def test_pooling_is_associative():
    rng = np.random.default_rng(2)
    total, weight = rng.integers(0, 4, 60).astype(float), rng.integers(4, 6, 60).astype(float)
    at = np.arange(60.0)
    whole = pool(at, at, total, weight)
    for cut in (1, 20, 41):
        parts = pool(at[:cut], at[:cut], total[:cut], weight[:cut]) + pool(at[cut:], at[cut:], total[cut:], weight[cut:])
        assert pool(*np.array(parts).T) == whole
