"""Data quality: column expectations, keys, references, order in time, schema shape."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas as S


@dataclass(frozen=True)
class Expectation:
    """A value check on one column. Missing values are the business of ``not_nullable``."""

    column: str
    check: str
    failed: Column


def _not_null(c: str, double: bool = False) -> Expectation:
    """In a column of doubles NaN is missing too."""
    missing = F.col(c).isNull()
    return Expectation(c, "not_nullable", missing | F.isnan(c) if double else missing)


def _isin(c: str, values: list) -> Expectation:
    return Expectation(c, f"isin({values})", ~F.col(c).isin(values))


def _prefix(c: str, text: str) -> Expectation:
    return Expectation(c, f"str_startswith('{text}')", ~F.col(c).startswith(text))


def _above(c: str, low) -> Expectation:
    return Expectation(c, f"greater_than({low})", F.col(c) <= low)


def _at_least(c: str, low) -> Expectation:
    return Expectation(c, f"greater_than_or_equal_to({low})", F.col(c) < low)


def _between(c: str, low, high) -> Expectation:
    return Expectation(c, f"in_range({low}, {high})", ~F.col(c).between(low, high) & (F.col(c).cast("string") != "NaN"))


UNIQUE_KEYS = {
    "customers": "customer_id", "merchants": "merchant_id", "devices": "device_id",
    "transactions": "transaction_id", "ground_truth": "transaction_id",
    "features": "transaction_id",
}
NULLABLE = {"ground_truth": {"confirmed_fraud_at"}}


def expectations(entity: str) -> list[Expectation]:
    """The declared checks of an entity, null checks first. Needs a running session."""
    nullable = NULLABLE.get(entity, set())
    present = [_not_null(f.name, isinstance(f.dataType, T.DoubleType))
               for f in S.ENTITIES[entity] if f.name not in nullable]
    values = {
        "customers": lambda: [
            _prefix("customer_id", "CUST"), _isin("customer_segment", S.CUSTOMER_SEGMENTS),
            _isin("home_country", S.COUNTRIES)],
        "merchants": lambda: [
            _prefix("merchant_id", "MERC"), _isin("merchant_category", S.MERCHANT_CATEGORIES),
            _isin("country", S.COUNTRIES)],
        "devices": lambda: [_prefix("device_id", "DEV"), _isin("device_type", S.DEVICE_TYPES)],
        "transactions": lambda: [
            _prefix("transaction_id", "TXN"), _above("amount", 0),
            _isin("currency", S.CURRENCIES), _isin("payment_method", S.PAYMENT_METHODS),
            _isin("country", S.COUNTRIES), _isin("ip_country", S.COUNTRIES)],
        "ground_truth": lambda: [
            _between("fraud_probability_true", 0, 1), _isin("fraud_label", [0, 1])],
        "features": lambda: [
            _prefix("transaction_id", "TXN"), _above("amount", 0),
            _isin("payment_method", S.PAYMENT_METHODS), _between("hour_of_day", 0, 23),
            _above("amount_vs_customer_p95", 0), _at_least("txn_count_1h", 0),
            _at_least("txn_count_24h", 0), _at_least("device_age_days", 0),
            _at_least("customer_device_count_so_far", 0),
            _between("merchant_fraud_rate_hist", 0, 1),
            *[_isin(c, [0, 1]) for c in S.FLAG_COLUMNS]],
    }
    return present + values[entity]()


def for_columns(checks: list[Expectation], df: DataFrame) -> list[Expectation]:
    return [e for e in checks if e.column in df.columns]


def column_checks(df: DataFrame, checks: list[Expectation]) -> DataFrame:
    """Every check with the number of rows failing it, from one scan."""
    counts = df.agg(*[F.count_if(e.failed).alias(f"f{i}") for i, e in enumerate(checks)])
    lines = F.array(*[
        F.struct(F.lit(e.column).alias("column"), F.lit(e.check).alias("check"),
                 F.col(f"f{i}").alias("failures"))
        for i, e in enumerate(checks)
    ])
    return counts.select(F.inline(lines).alias("column", "check", "failures"))


def failure_cases(df: DataFrame, checks: list[Expectation], key: str) -> DataFrame:
    """One row per failing cell: key, column, check, and the offending value as text."""
    cells = F.array(*[
        F.when(e.failed, F.struct(
            F.lit(e.column).alias("column"), F.lit(e.check).alias("check"),
            F.col(e.column).cast("string").alias("failure_case")))
        for e in checks
    ])
    return df.select(
        key, F.inline(F.array_compact(cells)).alias("column", "check", "failure_case"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """The uniqueness check as a ``column_checks`` line: rows that share their key."""
    return duplicate_keys(df, [key]).agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("failures")
    ).select(F.lit(key).alias("column"), F.lit("field_uniqueness").alias("check"), "failures")


def schema_differences(spark: SparkSession, actual: T.StructType,
                       declared: T.StructType) -> DataFrame:
    """Strictness as data: undeclared, missing and differently typed columns."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in declared}
    lines = (
        [(c, "column_in_schema", have[c]) for c in have if c not in want]
        + [(c, "column_in_dataframe", None) for c in want if c not in have]
        + [(c, f"dtype('{want[c]}')", have[c]) for c in want if c in have and have[c] != want[c]]
    )
    return spark.createDataFrame(lines, "column string, check string, failure_case string")


def validate(df: DataFrame, entity: str, unique: bool = True) -> DataFrame:
    """The full report of an entity: strict columns, value checks, uniqueness.

    Columns: column, check, failures. Every check is listed, passed ones with 0.
    """
    shape = schema_differences(df.sparkSession, df.schema, S.ENTITIES[entity]).select(
        "column", "check", F.lit(1).cast("bigint").alias("failures"))
    report = shape.unionByName(column_checks(df, for_columns(expectations(entity), df)))
    key = UNIQUE_KEYS[entity]
    if unique and key in df.columns:
        report = report.unionByName(uniqueness(df, key))
    return report


class QualityError(ValueError):
    pass


def require_valid(df: DataFrame, entity: str) -> DataFrame:
    """``df`` itself, or QualityError listing the failed checks (at most one per check)."""
    failed = validate(df, entity).where("failures > 0").collect()
    if failed:
        raise QualityError("; ".join(f"{r['column']}: {r['check']} x{r['failures']}"
                                     for r in failed))
    return df


def scored_summary(decisions: DataFrame, limit: int = 500) -> DataFrame:
    """One row about the newest ``limit`` scored rows: how many, passed or not, failed cells.

    A transaction may be scored many times, so uniqueness is not asked for; rows with no
    payload are skipped; nothing to check counts as passed.
    """
    recent = newest_payloads(decisions, limit)
    checks = expectations("features")
    bad = sum((F.when(e.failed, 1).otherwise(0) for e in checks), F.lit(0))
    return recent.agg(
        F.count("*").alias("checked_rows"),
        F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("failed_cells"),
    ).select("checked_rows", (F.col("failed_cells") == 0).alias("passed"), "failed_cells")


def scored_failures(decisions: DataFrame, limit: int = 500) -> DataFrame:
    """Every failing cell of the newest ``limit`` scored rows: transaction, column, check, value."""
    return failure_cases(newest_payloads(decisions, limit), expectations("features"), "transaction_id")


def newest_payloads(decisions: DataFrame, limit: int) -> DataFrame:
    """Feature rows of the newest ``limit`` decisions, those without a payload left out."""
    newest = decisions.orderBy(F.desc("id")).limit(limit).where("feature_row is not null")
    return newest.select("feature_row.*").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.FEATURES])


# ---------------------------------------------------------------- across tables

def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def orphan_counts(tables: dict[str, DataFrame], references: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """``reference, orphans`` of many references at once, over one scan of each table.

    A reference is (name, child table, its column, parent table, its column). Keys of all
    references meet in one grouping, after each task has counted its own, so neither a
    frequent key nor a large parent is joined. A missing key refers to nothing and counts as an orphan;
    a reference without orphans has 0.
    """
    def whole(table: str, column: str) -> bool:
        return isinstance(tables[table].schema[column].dataType, T.IntegralType)

    counted = None
    # Whole numbers are grouped as such, all else as text.
    for kind, wanted in (("bigint", True), ("string", False)):
        own = [r for r in references if (whole(r[1], r[2]) and whole(r[3], r[4])) == wanted]
        marks = None
        for table, rows in tables.items():
            uses = [(name, column, 0) for name, child, column, _, _ in own if child == table]
            uses += [(name, column, 1) for name, _, _, parent, column in own if parent == table]
            if uses:
                cells = F.array(*[F.struct(F.lit(name).alias("reference"), F.col(column).cast(kind).alias("key"), F.lit(parent).alias("parent"))
                                  for name, column, parent in uses])
                part = rows.select(F.inline(cells))
                marks = part if marks is None else marks.unionByName(part)
        if marks is not None:
            keys = marks.groupBy("reference", "key").agg(F.max("parent").alias("known"), F.sum(1 - F.col("parent")).alias("rows"))
            part = keys.groupBy("reference").agg(
                F.sum(F.when((F.col("known") == 0) | F.col("key").isNull(), F.col("rows"))).alias("orphans"))
            counted = part if counted is None else counted.unionByName(part)
    names = tables[references[0][1]].sparkSession.createDataFrame([(r[0],) for r in references], "reference string")
    return names.join(counted, "reference", "left").select("reference", F.coalesce("orphans", F.lit(0)).alias("orphans"))


def missing_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``child`` that ``parent`` lacks."""
    return child.select(key).subtract(parent.select(key))


def device_owner_mismatch(transactions: DataFrame, devices: DataFrame) -> DataFrame:
    owners = devices.select("device_id", F.col("customer_id").alias("owner"))
    return transactions.join(owners, "device_id").where("owner <> customer_id").select(
        "transaction_id", "device_id", "customer_id", "owner")


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys only on the left, only on the right, and repeated on either side.

    Each side is reduced to a count per key first, so nothing multiplies.
    """
    a = left.groupBy(key).agg(F.count("*").alias("n_left"))
    b = right.groupBy(key).agg(F.count("*").alias("n_right"))
    return a.join(b, key, "full_outer").agg(
        F.count_if(F.col("n_right").isNull()).alias("only_left"),
        F.count_if(F.col("n_left").isNull()).alias("only_right"),
        F.count_if((F.col("n_left") > 1) | (F.col("n_right") > 1)).alias("repeated"),
    )


def confirmed_before_transaction(transactions: DataFrame, ground_truth: DataFrame) -> DataFrame:
    confirmed = ground_truth.where("confirmed_fraud_at is not null").select(
        "transaction_id", "confirmed_fraud_at")
    return transactions.select("transaction_id", "timestamp").join(
        confirmed, "transaction_id").where("confirmed_fraud_at < timestamp")


def leaking_columns(df: DataFrame, forbidden: list[str]) -> list[str]:
    return [c for c in df.columns if c in forbidden]


# Columns that must never reach a feature or entity table.
FORBIDDEN_COLUMNS = [
    "fraud_label", "fraud_probability_true", "confirmed_fraud_at", "base_fraud_rate",
]
