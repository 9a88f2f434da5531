"""The decision log: building it, paging through it, and its monitoring figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.rules import decide, evaluate_rules
from riskloom.functions.scalar import minute_key
from riskloom.operators.ordered import running_totals
from riskloom.schemas import DECISIONS, FEATURE_COLUMNS

MAX_PAGE = 500


def decision_records(scored_features: DataFrame, t_review: float, t_block: float,
                     model_run_id: str, top_features: Column | None = None,
                     score: str = "model_score", carried: list[str] | None = None) -> DataFrame:
    """Feature rows with a score to decision records, in one projection.

    The score is recorded also when a rule decides. ``carried`` columns (an id, a
    creation time) pass through.
    """
    ruled = decide(evaluate_rules(scored_features), t_review, t_block, score)
    return ruled.select(
        *(carried or []), "transaction_id", F.col(score).alias("model_score"), "decision",
        "triggered_rules", "decision_source", F.lit(model_run_id).alias("model_run_id"),
        (top_features if top_features is not None
         else F.create_map().cast("map<string,double>")).alias("shap_top_features"),
        F.struct(*FEATURE_COLUMNS).alias("feature_row"),
    )


def page(decisions: DataFrame, limit: int = 50, before_id: int | None = None,
         decision: str | None = None) -> DataFrame:
    """Newest first, at most ``limit`` (1 to 500) rows older than ``before_id``.

    ``next_cursor`` holds the id to continue from, or null on the last page.
    """
    limit = min(max(limit, 1), MAX_PAGE)
    rows = decisions
    if decision is not None:
        rows = rows.where(F.col("decision") == decision)
    if before_id is not None:
        rows = rows.where(F.col("id") < before_id)
    # One row more than the page tells whether another page follows.
    ahead = rows.orderBy(F.desc("id")).limit(limit + 1)
    newest_first = W.orderBy(F.desc("id"))  # over at most MAX_PAGE + 1 rows
    everything = newest_first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    placed = ahead.withColumns({
        "__place": F.row_number().over(newest_first), "__found": F.count("*").over(everything)})
    last = F.min(F.when(F.col("__place") <= limit, F.col("id"))).over(everything)
    return placed.withColumn("next_cursor", F.when(F.col("__found") > limit, last)).where(
        F.col("__place") <= limit).drop("__place", "__found")


def offset_page(decisions: DataFrame, page_number: int, size: int = 10) -> DataFrame:
    """Page ``page_number`` (from 0) of the log, newest first."""
    return decisions.orderBy(F.desc("id")).offset(page_number * size).limit(size)


def newest(decisions: DataFrame, n: int) -> DataFrame:
    return decisions.orderBy(F.desc("id")).limit(n)


def oldest(rows: DataFrame, n: int, key: str = "transaction_id") -> DataFrame:
    """The first ``n`` rows in key order."""
    return rows.orderBy(key).limit(n)


def since(decisions: DataFrame, as_of: dt.datetime | str, minutes: int) -> DataFrame:
    """Decisions of the ``minutes`` before ``as_of``, its left edge included."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(minutes))
    return decisions.where(F.col("created_at") >= cutoff)


def stats(decisions: DataFrame) -> DataFrame:
    """Totals per outcome and the mean score; an empty log gives zeros."""
    return decisions.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("decision") == d).alias(f"{d}_count") for d in DECISIONS],
        F.coalesce(F.avg("model_score"), F.lit(0.0)).alias("avg_score"),
    )


def by_minute(decisions: DataFrame) -> DataFrame:
    counts = decisions.groupBy(minute_key("created_at").alias("minute"), "decision").agg(
        F.count("*").alias("count"))
    return counts.orderBy("minute", "decision")


def by_minute_wide(decisions: DataFrame) -> DataFrame:
    """One row per minute with a zero-filled column per outcome."""
    return (
        decisions.groupBy(minute_key("created_at").alias("minute"))
        .agg(*[F.count_if(F.col("decision") == d).alias(d) for d in DECISIONS])
        .orderBy("minute")
    )


def kpi_cards(decisions: DataFrame, as_of: dt.datetime | str, minutes: int = 1440) -> DataFrame:
    """Per outcome: the count over all time and over the last day, in one pass."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(minutes))
    recent = F.col("created_at") >= cutoff
    counts = decisions.agg(*[
        c for d in DECISIONS for c in (
            F.count_if(F.col("decision") == d).alias(f"{d}_all"),
            F.count_if((F.col("decision") == d) & recent).alias(f"{d}_recent"))
    ])
    lines = F.array(*[
        F.struct(F.lit(d).alias("decision"), F.col(f"{d}_all").alias("all_time"),
                 F.col(f"{d}_recent").alias("recent"))
        for d in DECISIONS
    ])
    return counts.select(F.inline(lines).alias("decision", "all_time", "recent"))


def latest_per_transaction(decisions: DataFrame) -> DataFrame:
    """The newest decision of every transaction.

    An aggregate rather than a window: a transaction replayed many times is reduced
    before the shuffle.
    """
    rest = [c for c in decisions.columns if c not in ("transaction_id", "created_at", "id")]
    newest_row = F.max_by(F.struct(*decisions.columns), F.struct("created_at", "id"))
    picked = decisions.groupBy("transaction_id").agg(newest_row.alias("row"))
    return picked.select("transaction_id", "row.created_at", "row.id",
                         *[F.col(f"row.{c}") for c in rest])


def investigation(decisions: DataFrame, transaction_id: str) -> DataFrame:
    """The newest decision of one transaction, or no row."""
    return decisions.where(F.col("transaction_id") == transaction_id).orderBy(
        F.desc("created_at"), F.desc("id")).limit(1)


def sample_rows(rows: DataFrame, n: int, seed: int = 42, key: str = "transaction_id") -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the same ones for the same seed.

    Rows are ranked by a hash of key and seed, so the result does not depend on how the
    table is laid out.
    """
    # As a column, the hash is computed once a row; as an order, at every comparison.
    ranked = rows.withColumn("__rank", F.md5(F.concat_ws(":", F.col(key), F.lit(seed))))
    return ranked.orderBy("__rank").limit(n).drop("__rank")


def cyclic_batch(pool: DataFrame, cursor: int, size: int, key: str = "transaction_id",
                 **limits) -> DataFrame:
    """``size`` rows of the pool in key order from position ``cursor``, wrapping around.

    Adds ``slot`` (0-based place in the batch) and ``next_cursor``. An empty pool gives
    no rows, and the cursor stays where it was.
    """
    total = pool.count()
    if total == 0:
        return pool.withColumns({"slot": F.lit(0).cast("bigint"),
                                 "next_cursor": F.lit(cursor).cast("bigint")})
    placed = running_totals(pool.withColumn("__one", F.lit(1)), [], [key], ["__one"],
                            rows_bound=total, **limits)
    first = F.pmod(F.col("__one_before") - cursor, F.lit(total))
    # A batch longer than the pool repeats rows.
    return placed.withColumn("__first", first).where(F.col("__first") < size).select(
        *pool.columns,
        F.explode(F.sequence("__first", F.lit(size - 1).cast("bigint"),
                             F.lit(total).cast("bigint"))).alias("slot"),
        F.lit((cursor + size) % total).cast("bigint").alias("next_cursor"),
    )
