"""Drift per column with the test that suits it, from counts alone.

A column's test follows from its type, the distinct values of the reference and its size:

====================  =========================  ======================================
column                reference of few rows      larger reference
====================  =========================  ======================================
numeric, more than 5  two-sample Kolmogorov-     1-Wasserstein distance over the standard
distinct values       Smirnov                    deviation of the reference
two values or fewer   two-proportion z           Jensen-Shannon distance
other                 chi-square against the     Jensen-Shannon distance
                      reference's shares
====================  =========================  ======================================

A p-value below 0.05 or a distance of at least 0.1 counts as drift. All numeric columns share
one ordered pass over their distinct values, all categorical ones another grouping; what is
left is a row of counts per column, and the p-values are computed on those.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import drift
from riskloom.operators.ordered import running_totals
from riskloom.schemas import NUMERIC_FEATURES

# Where the choice of a test changes, and from where on a column drifted.
SMALL_REFERENCE = 1000
CATEGORIES = 5
SIGNIFICANCE = 0.05
DISTANCE = 0.1
#: Cells of the exact Kolmogorov-Smirnov count; beyond that the limiting distribution serves.
EXACT_CELLS = 1_000_000


# p-values from counts

def ks_p(gap: int, n: int, m: int) -> float:
    """Two-sided p-value of the largest gap of two samples' shares, ``gap`` being n * m times it."""
    if not n or not m or gap <= 0:
        return 1.0
    if n * m > EXACT_CELLS:
        x = gap / (n * m) * math.sqrt(n * m / (n + m))
        if x < 0.2:
            return 1.0
        terms = (2 * (-1) ** (k - 1) * math.exp(-2 * (k * x) ** 2) for k in range(1, 101))
        return min(1.0, max(0.0, sum(terms)))
    # Share of orders of the n + m values in which the gap stays smaller, by diagonals: after
    # d values, i of them from the first sample, the last came from it in i of d cases.
    inside = np.array([1.0])
    for d in range(1, n + m + 1):
        i = np.arange(max(0, d - m), min(n, d) + 1)
        before = np.zeros(min(n, d) + 2)
        low = max(0, d - 1 - m)
        before[low + 1:low + 1 + len(inside)] = inside
        inside = (before[i] * i + before[i + 1] * (d - i)) / d
        inside[np.abs(i * m - (d - i) * n) >= gap] = 0.0
    return float(min(1.0, max(0.0, 1.0 - inside[-1])))


def chi_square_p(statistic: float, freedom: int) -> float:
    """Upper tail of the chi-square distribution, as a finite sum."""
    if freedom <= 0:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    half = statistic / 2
    if freedom % 2 == 0:
        term, total = 1.0, 1.0
        for k in range(1, freedom // 2):
            term *= half / k
            total += term
        return math.exp(-half) * total
    total, term = math.erfc(math.sqrt(half)), math.exp(-half) * math.sqrt(half / math.pi) * 2
    for k in range(1, freedom // 2 + 1):
        total += term
        term *= half / (k + 0.5)
    return min(1.0, total)


def proportions_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


# Counts per column

_COUNTS = ["column", "numeric", "reference_rows", "current_rows", "distinct", "distinct_here", "gap", "chi_square", "z",
           "wasserstein", "js"]


def _share_columns() -> list[Column]:
    """What the value counts ``ref`` and ``cur`` of a column with totals ``n`` and ``m`` say."""
    n, m, ref, cur = (F.col(c) for c in ("n", "m", "ref", "cur"))
    expected = F.try_divide(ref * m, n)
    cell = F.when(ref > 0, F.try_divide((cur - expected) ** 2, expected)).when(cur > 0, F.lit(float("inf"))).otherwise(0.0)
    p, q = F.try_divide(ref, n), F.try_divide(cur, m)
    middle = (p + q) / 2
    parts = sum((F.when(x > 0, x * F.ln(x / middle)).otherwise(0.0) for x in (p, q)), F.lit(0.0))
    return [
        F.max("n").alias("reference_rows"), F.max("m").alias("current_rows"),
        F.count_if(ref > 0).alias("distinct"), F.count("*").alias("distinct_here"),
        F.sum(cell).alias("chi_square"), F.max_by(p, "value").alias("p"), F.max_by(q, "value").alias("q"),
        F.sqrt(F.greatest(F.sum(parts) / 2, F.lit(0.0))).alias("js"),
    ]


def _z() -> Column:
    n, m, p, q = (F.col(c) for c in ("reference_rows", "current_rows", "p", "q"))
    pooled = F.try_divide(p * n + q * m, n + m)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), m)))
    return F.when(spread > 0, (p - q) / spread).otherwise(0.0).alias("z")


def _numeric(reference: DataFrame, current: DataFrame, columns: list[str], **options) -> DataFrame:
    steps = running_totals(drift._long(reference, current, columns), ["column"], ["value"], ["ref", "cur"],
                           previous="value", **options)
    n, m = F.col("ref_total"), F.col("cur_total")
    gap = F.abs((F.col("ref_before") + F.col("ref")).cast("decimal(38,0)") * m - (F.col("cur_before") + F.col("cur")) * n)
    before = F.abs(F.try_divide("ref_before", "ref_total") - F.try_divide("cur_before", "cur_total"))
    width = F.coalesce(F.col("value") - F.col("previous_value"), F.lit(0.0))
    deviations = reference.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in columns])
    sd = F.coalesce(deviations.select(F.create_map(
        *[x for c in columns for x in (F.lit(c), F.col(c))])).scalar()[F.col("column")], F.lit(0.0))
    counted = steps.withColumns({"n": n, "m": m}).groupBy("column").agg(
        *_share_columns(), F.max(gap).alias("gap"), F.sum(before * width).alias("area")).withColumn("sd", sd)
    return counted.select(
        "column", F.lit(True).alias("numeric"), "reference_rows", "current_rows", "distinct", "distinct_here",
        F.col("gap").cast("double").alias("gap"), "chi_square", _z(),
        (F.col("area") / F.when(F.col("sd") > 1e-9, F.col("sd")).otherwise(1.0)).alias("wasserstein"), "js")


def _categorical(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    def melt(df: DataFrame, side: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        return df.select(F.inline(cells), F.lit(side).alias("side"))

    counts = melt(reference, "ref").unionByName(melt(current, "cur")).where("value is not null").groupBy(
        "column", "value").agg(F.count_if(F.col("side") == "ref").alias("ref"), F.count_if(F.col("side") == "cur").alias("cur"))
    # One row per column joins back: value counts of any number stay spread out.
    totals = counts.groupBy("column").agg(F.sum("ref").alias("n"), F.sum("cur").alias("m"))
    counted = counts.join(F.broadcast(totals), "column").groupBy("column").agg(*_share_columns())
    nothing = F.lit(None).cast("double")
    return counted.select(
        "column", F.lit(False).alias("numeric"), "reference_rows", "current_rows", "distinct", "distinct_here",
        nothing.alias("gap"), "chi_square", _z(), nothing.alias("wasserstein"), "js")


def column_counts(reference: DataFrame, current: DataFrame, numeric: list[str] = NUMERIC_FEATURES,
                  categorical: list[str] = ("payment_method",), **options) -> DataFrame:
    """One row of counts, statistics and distances per column; missing values don't count."""
    out = _numeric(reference, current, list(numeric), **options).select(*_COUNTS) if numeric else None
    if categorical:
        other = _categorical(reference, current, list(categorical)).select(*_COUNTS)
        out = other if out is None else out.unionByName(other)
    return out


@F.pandas_udf(T.DoubleType())
def _p_value(method: pd.Series, gap: pd.Series, n: pd.Series, m: pd.Series, chi: pd.Series, z: pd.Series,
             distinct: pd.Series) -> pd.Series:
    """One row per column comes here."""
    out = []
    for kind, g, a, b, x, s, k in zip(method, gap, n, m, chi, z, distinct):
        if kind == "kolmogorov_smirnov":
            out.append(ks_p(round(g), int(a), int(b)))
        elif kind == "chi_square":
            out.append(chi_square_p(x, int(k) - 1))
        else:
            out.append(proportions_p(s) if kind == "proportions_z" else None)
    return pd.Series(out, dtype="float64")


def column_tests(reference: DataFrame, current: DataFrame, numeric: list[str] = NUMERIC_FEATURES,
                 categorical: list[str] = ("payment_method",), mode: str = "auto", small: int = SMALL_REFERENCE,
                 **options) -> DataFrame:
    """``column, method, statistic, p_value, drifted`` of every column that has values.

    ``mode`` is ``auto`` (p-values up to ``small`` reference rows with a value, distances
    beyond), ``p_value`` or ``distance``. A distance has no p-value. Where a side has no
    value, the statistic is 0, the p-value 1 and nothing drifted. A value the reference never has makes
    the chi-square statistic infinite.
    """
    if mode not in ("auto", "p_value", "distance"):
        raise ValueError(f"unknown mode {mode}")
    counts = column_counts(reference, current, numeric, categorical, **options)
    tested = {"auto": F.col("reference_rows") <= small, "p_value": F.lit(True), "distance": F.lit(False)}[mode]
    many = F.col("numeric") & (F.col("distinct") > CATEGORIES)
    method = (
        F.when(tested & many, "kolmogorov_smirnov").when(tested & (F.col("distinct_here") <= 2), "proportions_z")
        .when(tested, "chi_square").when(many, "wasserstein").otherwise("jensen_shannon"))
    n, m = F.col("reference_rows"), F.col("current_rows")
    statistic = (
        F.when(method == "kolmogorov_smirnov", F.try_divide(F.col("gap"), n * m)).when(method == "proportions_z", F.col("z"))
        .when(method == "chi_square", F.col("chi_square")).when(method == "wasserstein", F.col("wasserstein"))
        .otherwise(F.col("js")))
    filled = (n > 0) & (m > 0)
    found = counts.withColumn("method", method).select(
        "column", "method", F.when(filled, statistic).otherwise(0.0).alias("statistic"), "gap",
        n.alias("n"), m.alias("m"), "chi_square", "z", "distinct_here", tested.alias("tested"), filled.alias("filled"))
    p = F.when(F.col("tested"), F.when(F.col("filled"), _p_value(
        "method", "gap", "n", "m", "chi_square", "z", "distinct_here")).otherwise(1.0))
    drifted = F.when(F.col("tested"), F.col("p_value") < SIGNIFICANCE).otherwise(F.col("statistic") >= DISTANCE)
    return found.withColumn("p_value", p).select("column", "method", "statistic", "p_value", drifted.alias("drifted"))


def tests_summary(tests: DataFrame, current: DataFrame) -> DataFrame:
    """One row: rows checked, how many columns drifted and their share."""
    return drift.drift_summary(tests, current)
