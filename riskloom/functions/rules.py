"""Decision rules and score bands as columns.

Rules can raise the level the score asks for; the allowlist overrides both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rule set: levels, thresholds, rule names and example allowlists.
LEVELS = ["approve", "review", "block"]
VELOCITY_LIMIT = 5
MERCHANT_RATE_LIMIT = 0.15
AMOUNT_RATIO_LIMIT = 3.0
ALLOWLIST_RULE = "trusted_allowlist"
ALLOWED_CUSTOMERS = ["CUST-EXAMPLE-ALLOWLISTED"]
ALLOWED_MERCHANTS = ["MERC-EXAMPLE-ALLOWLISTED"]


def _on(flag: str) -> Column:
    return F.col(flag).cast("int") != 0


def _rules() -> list[tuple[str, str, Column]]:
    """(name, level it asks for, condition), in reporting order."""
    return [
        ("device_location_takeover", "block",
         _on("is_new_device") & _on("is_new_country_for_customer") & _on("ip_country_mismatch")),
        ("velocity_spike", "block", F.col("txn_count_1h") >= VELOCITY_LIMIT),
        ("high_risk_merchant", "review",
         F.col("merchant_fraud_rate_hist") > MERCHANT_RATE_LIMIT),
        ("outsized_amount_new_device", "review",
         (F.col("amount_vs_customer_p95") > AMOUNT_RATIO_LIMIT) & _on("is_new_device")),
    ]


def level(decision: Column) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in LEVELS]), decision) - 1


def level_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LEVELS]), (rank + 1).cast("int"))


def evaluate_rules(rows: DataFrame, customers: list[str] | None = None,
                   merchants: list[str] | None = None) -> DataFrame:
    """Add ``triggered_rules``, ``rule_decision`` and ``is_allowlisted``.

    The lists are for short allowlists; see ``mark_allowlisted`` for tables of any size.
    """
    if "is_allowlisted" not in rows.columns:
        rows = rows.withColumn(
            "is_allowlisted",
            F.col("customer_id").isin(customers if customers is not None else ALLOWED_CUSTOMERS)
            | F.col("merchant_id").isin(merchants if merchants is not None else ALLOWED_MERCHANTS),
        )
    rules = _rules()
    names = [F.when(condition, F.lit(name)) for name, _, condition in rules]
    names.append(F.when(F.col("is_allowlisted"), F.lit(ALLOWLIST_RULE)))
    asked = [F.when(condition, LEVELS.index(asks)).otherwise(0) for _, asks, condition in rules]
    return rows.select(
        "*", F.array_compact(F.array(*names)).alias("triggered_rules"),
        level_name(F.greatest(*asked)).alias("rule_decision"),
    )


def mark_allowlisted(rows: DataFrame, allowed_customers: DataFrame,
                     allowed_merchants: DataFrame) -> DataFrame:
    """Add ``is_allowlisted`` from allowlist tables, one row per id."""
    c = allowed_customers.select("customer_id", F.lit(True).alias("__c")).distinct()
    m = allowed_merchants.select("merchant_id", F.lit(True).alias("__m")).distinct()
    return (
        rows.join(c, "customer_id", "left").join(m, "merchant_id", "left")
        .select(*rows.columns, F.coalesce("__c", "__m", F.lit(False)).alias("is_allowlisted"))
    )


def score_band(score: str | Column, t_review: float, t_block: float) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score >= t_block, "block").when(score >= t_review, "review").otherwise("approve")
    )


def decide(rows: DataFrame, t_review: float, t_block: float,
           score: str = "model_score") -> DataFrame:
    """Add ``decision`` and ``decision_source`` to rows that went through the rules.

    A rule that fired wins when its level is at least the score's.
    """
    band = score_band(score, t_review, t_block)
    fired = F.size(F.array_remove("triggered_rules", ALLOWLIST_RULE)) > 0
    rule_wins = fired & (level(F.col("rule_decision")) >= level(band))
    return rows.select(
        "*",
        F.when(F.col("is_allowlisted"), "approve")
        .when(rule_wins, F.col("rule_decision")).otherwise(band).alias("decision"),
        F.when(F.col("is_allowlisted"), "rule_override")
        .when(rule_wins, "rule").otherwise("model").alias("decision_source"),
    )
