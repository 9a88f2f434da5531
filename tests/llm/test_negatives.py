"""Hard negatives against loops over Python integers."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label string, score string, _row int, rank double, anchor_id int"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2.0, 3) for i, v, label in rows], SCHEMA)


def plain(rows, positives=5, negatives_=3, scale=256, low=50, high=95, every=50):
    good = [(n, i, [math.floor(scale * x) for x in v], label) for n, (i, v, label) in enumerate(rows)
            if v is not None and label is not None and all(x is not None and math.isfinite(x * scale) for x in v)]
    out = []
    for n, i, v, label in good:
        if i is None or i % every:
            continue
        met = [(sum(a * b for a, b in zip(v, w)), j, other) for m, j, w, other in good if m != n and len(w) == len(v)]
        met.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for ps, p, _ in [r for r in met if r[2] == label][:positives]:
            far = [r for r in met if r[2] != label and low * ps <= 100 * r[0] <= high * ps][:negatives_]
            out += [(i, p, k + 1, q, fits(ps), fits(s)) for k, (s, q, _) in enumerate(far)]
    return Counter(out)


def fits(v):
    return v if -2**63 <= v < 2**63 else None


def mined(spark, rows, **settings):
    got = negatives.hard_negatives(rows_of(spark, rows), **settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in got.collect())


def some(rng, n, dim, labels=4, size=1.0, start=0):
    centre = rng.standard_normal(dim)
    return [(start + i, ((centre + rng.standard_normal(dim)) * size).tolist(), f"l{rng.integers(labels)}") for i in range(n)]


@pytest.mark.parametrize("size", [0.1, 3e2, 1e9, 1e40])
def test_against_plain_loops(spark, size):
    """Through doubles, 64 bits and long Python integers as the wide integer."""
    rows = some(np.random.default_rng(1), 260, 12, size=size)
    want = plain(rows)
    assert mined(spark, rows) == want and sum(want.values()) > 20


def test_ties_copies_and_rows_left_out(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-1, 3, 5) / 256).tolist(), f"l{i % 3}") for i in range(130)]
    rows += [rows[50]] * 3 + [rows[7]] * 40 + [(100, rows[0][1], "l0"), (None, rows[3][1], "l0"), (None, rows[4][1], "l1")]
    rows += [(200, None, "l0"), (250, [1.0] * 5, None), (300, [math.nan] + [0.0] * 4, "l0"), (350, [None] + [0.0] * 4, "l0"),
             (400, [math.inf] * 5, "l1"), (450, [1e306] * 5, "l1"), (500, [], "l0"), (501, [], "l0"), (502, [], "l1"),
             (550, [0.5, 0.5], "l0"), (551, [0.5, 0.4], "l0"), (552, [0.4, 0.4], "l1"), (-50, rows[1][1], "l2"), (600, [1.0] * 7, "alone"),
             (650, [0.25] * 4, "n"), (None, [0.25] * 4, "n"), (None, [0.2] * 4, "m")]
    want = plain(rows)
    assert mined(spark, rows) == want
    assert {0, 50, 100, 500, 550, -50} <= {r[0] for r in want} and (650, None, 1, None) in {r[:4] for r in want}


def test_many_blocks_find_the_same(spark):
    rows = some(np.random.default_rng(3), 400, 8, size=0.2)
    anchors = F.col("vec_id") % 4 == 0
    want = plain(rows, every=4)
    for block_bytes in (1 << 20, 3000):
        assert mined(spark, rows, anchor=anchors, block_bytes=block_bytes) == want


def test_empty_and_no_anchor(spark):
    for rows in ([], [(1, [1.0], "a"), (2, [1.0], "b")], [(50, None, "a")], [(50, [1.0], "a")]):
        assert not mined(spark, rows)
    assert not mined(spark, [(None, None, None)])


def test_a_hot_label_and_other_counts(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v, "hot" if i % 3 else f"l{i % 5}") for i, v, _ in some(rng, 300, 6)]
    assert mined(spark, rows, positives=2, negatives=7, low=10, high=90) == plain(rows, 2, 7, low=10, high=90)


@pytest.mark.parametrize("length,bias", [(64, 256), (64, 100), (7, 3), (64, 5000), (64, 10**9), (64, 10**30), (3, 0)])
def test_packed_products_are_exact(length, bias):
    """Extreme components fill the fields, and no field spills into the next."""
    rng = np.random.default_rng(5)
    packing = negatives.Packing(length, bias)
    draw = lambda n: np.array([[int(v) for v in row] for row in rng.integers(-1, 2, (n, length))], dtype=object) * bias
    a, c = draw(9), draw(53)
    a[0], c[0], c[1] = bias, bias, -bias
    kind = object if packing.kind is object else np.int64
    a, c = a.astype(kind), c.astype(kind)
    got = packing.scores(a, c, packing.packed(c))
    for i in range(len(a)):
        for j in range(len(c)):
            assert int(got[i, j]) == sum(int(x) * int(y) for x, y in zip(a[i], c[j]))
    assert packing.fields >= 2


def test_largest_block_first_rows_small():
    """Rows are regrouped without loss, small groups first."""
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"v": list(range(s, s + 100))}) for s in range(0, 5000, 100)]
    got = list(negatives._put_together(iter(batches)))
    assert [v for t in got for v in t["v"].to_pylist()] == list(range(5000))
    assert len(got[0]) == 64 and max(map(len, got)) <= negatives.ROWS
