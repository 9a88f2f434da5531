"""The registered queries: every operator run over the given tables.

Doubles are rounded to six digits so that both engines agree on them; arrays are
joined into text where a result is compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas as S
from riskloom.functions import rules
from riskloom.functions.scalar import utc_text
from riskloom.operators import (
    anomaly, attribution, calibration, decisions, drift, eda, features, metrics, model, ordered, policy,
    quality, registry, risk, splits, trees,
)
from riskloom.operators import drift_tests as by_column
from riskloom.plans import training
from riskloom.plans.workspace import (
    COEFFICIENTS, MODEL_RUN_ID, T_BLOCK, T_REVIEW, Workspace, workspace,
)
from riskloom.session import durable, new_shared_path
from riskloom.sources import sinks, tables
from riskloom.streaming import rollup, scoring, velocity

AS_OF = "2024-01-30 12:00:00"
SCALED = ["amount", "amount_vs_customer_p95", "device_age_days", "merchant_fraud_rate_hist"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
        for f in df.schema
    ])


def query(fn: Callable[[Workspace], DataFrame], digits: int = 6):
    """Register a query written against a workspace under its function name."""
    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        return rounded(fn(workspace(spark, data_dir)), digits)

    QUERIES[fn.__name__] = run
    return fn


# ---------------------------------------------------------------- features

@query
def feat_transaction(w):
    return features.transaction_features(w.transactions(), w.customers())


@query
def feat_behavioral(w):
    return features.behavioral_features(w.transactions())


@query
def feat_velocity(w):
    return features.velocity_features(w.transactions())


@query
def feat_device(w):
    return features.device_features(w.transactions(), w.devices())


@query
def feat_geo(w):
    return features.geo_features(w.transactions())


@query
def feat_merchant(w):
    return features.merchant_features(w.transactions(), w.ground_truth())


@query
def feature_table(w):
    return w.build_features()


def _orders_as_transactions(w) -> DataFrame:
    """Orders stand in for transactions: day-grained times, so many ties."""
    return w.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("merchant_id"),
        F.col("o_orderstatus").alias("device_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("o_totalprice").alias("amount"),
    )


@query
def ties_velocity(w):
    return features.velocity_features(_orders_as_transactions(w))


@query
def ties_behavioral(w):
    return features.behavioral_features(_orders_as_transactions(w))


@query
def ties_merchant(w):
    rows = _orders_as_transactions(w)
    truth = rows.select(
        "transaction_id",
        (F.col("amount") > 200000).cast("int").alias("fraud_label"),
        F.when(F.col("amount") > 200000, F.col("timestamp")).alias("confirmed_fraud_at"))
    return features.merchant_features(rows, truth)


# The same families over rows with missing values, and through the plans for long customers,
# heavy keys and large groups, which small data would not reach.
GROUPS = features.Limits(window_rows=2)
SPLIT = features.Limits(window_rows=2, customer_rows=8, device_rows=8, merchant_rows=8,
                        quantile_block_rows=16, one_task_rows=0)


def _with_holes(w) -> DataFrame:
    """Transactions that lack some amounts, countries and devices."""
    number = F.substring("transaction_id", 4, 10).cast("bigint")
    return w.transactions().withColumns({
        "amount": F.when(number % 13 != 0, F.col("amount")),
        "country": F.when(number % 17 != 0, F.col("country")),
        "device_id": F.when(number % 19 != 0, F.col("device_id"))})


def _plans(name: str, build) -> None:
    for plan, limits in (("windows", features.DEFAULT_LIMITS), ("groups", GROUPS), ("split", SPLIT)):
        def run(w, limits=limits):
            return build(w, limits)
        run.__name__ = f"{name}_{plan}"
        query(run)


_plans("holes_behavioral", lambda w, limits: features.behavioral_features(_with_holes(w), limits))
_plans("holes_geo", lambda w, limits: features.geo_features(_with_holes(w), limits))
_plans("holes_velocity", lambda w, limits: features.velocity_features(_with_holes(w), limits))
_plans("holes_device",
       lambda w, limits: features.device_features(_with_holes(w), w.devices(), limits))


@query
def feat_merchant_split(w):
    return features.merchant_features(w.transactions(), w.ground_truth(), limits=SPLIT)


@query
def model_matrix(w):
    return splits.model_matrix(w.features, keep=["transaction_id"])


@query
def training_rows(w):
    return w.labelled()


# ---------------------------------------------------------------- quality

@query
def dq_column_checks(w):
    checks = quality.column_checks(w.features, quality.expectations("features"))
    return checks.unionByName(quality.uniqueness(w.features, "transaction_id"))


@query
def dq_entity_report(w):
    """Every entity against its declaration, missing and undeclared columns included."""
    reports = [
        quality.validate(df, name).withColumn("entity", F.lit(name))
        for name, df in (
            ("customers", w.customers()), ("merchants", w.merchants()),
            ("devices", w.devices()), ("transactions", w.transactions()),
            ("ground_truth", w.ground_truth()))
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out.select("entity", "column", "check", "failures")


@query
def dq_failure_cases(w):
    checks = [e for e in quality.expectations("customers") if e.column == "customer_segment"]
    return quality.failure_cases(w.customers(), checks, "customer_id")


def _flaws(number: Column) -> dict[str, Column]:
    """Cells that fail checks, by the number of a transaction."""
    return {
        "amount": F.when(number % 97 == 0, None).when(number % 89 == 0, -5.5),
        "payment_method": F.when(number % 83 == 0, "cash"),
        "hour_of_day": F.when(number % 79 == 0, 24),
        "is_night": F.when(number % 73 == 0, 7),
        "merchant_fraud_rate_hist": F.when(number % 71 == 0, 1.5),
        "txn_count_1h": F.when(number % 67 == 0, -1),
    }


def _flawed(column: Callable[[str], Column]) -> dict[str, Column]:
    number = F.substring(column("transaction_id"), 4, 10).cast("bigint")
    whole = {"amount": (number % 97 != 0) & (number % 89 != 0)}
    return {c: F.when(whole.get(c, flaw.isNull()), column(c)).otherwise(flaw) for c, flaw in _flaws(number).items()}


@query
def dq_all_failure_cases(w):
    """Every failing cell of every check of every entity, features with planted faults among them."""
    flawed = w.features.withColumns(_flawed(F.col))
    out = None
    for name, rows, key in (
            ("customers", w.customers(), "customer_id"), ("merchants", w.merchants(), "merchant_id"),
            ("devices", w.devices(), "device_id"), ("transactions", w.transactions(), "transaction_id"),
            ("ground_truth", w.ground_truth(), "transaction_id"), ("features", flawed, "transaction_id")):
        checks = quality.for_columns(quality.expectations(name), rows)
        part = quality.failure_cases(rows, checks, key).withColumnRenamed(key, "key").withColumn("entity", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query
def dq_scored_failures(w):
    """Every failing cell of the newest 500 scored rows, over payloads with planted faults."""
    payload = F.col("feature_row")
    for name, value in _flawed(lambda c: F.col("feature_row")[c]).items():
        payload = payload.withField(name, value)
    return quality.scored_failures(w.decisions.withColumn("feature_row", payload), limit=500)


@query
def dq_duplicate_keys(w):
    return quality.duplicate_keys(w.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_scored_summary(w):
    return quality.scored_summary(w.decisions, limit=500)


def _number(key: str) -> Column:
    return F.regexp_extract(key, r"\d+", 0).cast("bigint")


def _without(df: DataFrame, key: str, every: int) -> DataFrame:
    """The table without each row whose number is a multiple of ``every``."""
    return df.where(_number(key) % every != 0)


def _flawed_truth(w) -> DataFrame:
    """Labels of which some are missing, some repeated and some confirmed too early."""
    number = _number("transaction_id")
    early = w.ground_truth().withColumn("confirmed_fraud_at", F.when(
        number % 3 == 0, F.col("confirmed_fraud_at") - F.expr("interval 5 days")).otherwise(F.col("confirmed_fraud_at")))
    return early.where(number % 23 != 0).unionByName(early.where(number % 29 == 0))


@query
def dq_fk_orphans(w):
    """Orphans of each reference, counted, over tables that do have some."""
    tables = {
        "orders": w.raw("orders").select("o_orderkey", "o_custkey"),
        "lines": w.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey"),
        "customer": w.raw("customer"), "part": w.raw("part"), "supplier": w.raw("supplier"),
        "transactions": w.transactions(), "devices": w.devices(),
        "customers_left": _without(w.customers(), "customer_id", 5),
        "merchants_left": _without(w.merchants(), "merchant_id", 11),
        "devices_left": _without(w.devices(), "device_id", 7),
        "documents": w.raw("documents"), "labels": w.raw("labels"),
    }
    return quality.orphan_counts(tables, [
        ("order_customer", "orders", "o_custkey", "customer", "c_custkey"),
        ("line_order", "lines", "l_orderkey", "orders", "o_orderkey"),
        ("line_part", "lines", "l_partkey", "part", "p_partkey"),
        ("line_supplier", "lines", "l_suppkey", "supplier", "s_suppkey"),
        ("transaction_customer", "transactions", "customer_id", "customers_left", "customer_id"),
        ("transaction_merchant", "transactions", "merchant_id", "merchants_left", "merchant_id"),
        ("transaction_device", "transactions", "device_id", "devices_left", "device_id"),
        ("device_customer", "devices", "customer_id", "customers_left", "customer_id"),
        ("label_document", "documents", "doc_id", "labels", "doc_id"),
    ])


@query
def set_except_keys(w):
    return quality.missing_keys(w.raw("documents"), w.raw("labels"), "doc_id")


@query
def dq_device_ownership(w):
    """Orders shipped by a supplier stand in for devices used by somebody else."""
    uses = w.raw("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("transaction_id"),
        F.col("l_partkey").alias("device_id"), F.col("l_suppkey").alias("customer_id"))
    owners = uses.groupBy("device_id").agg(F.min("customer_id").alias("customer_id"))
    return quality.device_owner_mismatch(uses, owners)


@query
def dq_one_to_one(w):
    a = quality.one_to_one(w.transactions(), _flawed_truth(w), "transaction_id").select(
        F.lit("transactions_ground_truth").alias("pair"), "*")
    b = quality.one_to_one(w.raw("documents"), w.raw("labels"), "doc_id").select(
        F.lit("documents_labels").alias("pair"), "*")
    c = quality.one_to_one(w.features, w.transactions(), "transaction_id").select(
        F.lit("features_transactions").alias("pair"), "*")
    return a.unionByName(b).unionByName(c)


@query
def dq_temporal_order(w):
    """Ship dates before the order date: a relation with violations."""
    lines = w.raw("lineitem").select(
        F.col("l_orderkey").alias("transaction_id"), F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("confirmed_fraud_at"))
    orders = w.raw("orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_orderdate").alias("timestamp"))
    late = quality.confirmed_before_transaction(orders, lines)
    clean = quality.confirmed_before_transaction(w.transactions(), _flawed_truth(w))
    return late.agg(F.count("*").alias("violations")).select(
        F.lit("ship_before_order").alias("relation"), "violations"
    ).unionByName(clean.agg(F.count("*").alias("violations")).select(
        F.lit("confirmed_before_transaction").alias("relation"), "violations"))


@query
def dq_schema_columns(w):
    """Columns of every given transaction-side table that its declaration does not know."""
    shape = quality.schema_differences(
        w.spark, w.transactions_plus().schema, S.TRANSACTIONS)
    forbidden = F.col("column").isin(quality.FORBIDDEN_COLUMNS)
    rows = w.transactions_plus().agg(F.count("*")).scalar()
    return shape.select("column", "check", forbidden.alias("forbidden"), rows.alias("rows"))


# ---------------------------------------------------------------- exploration

def _star(w) -> DataFrame:
    return eda.star(w.transactions(), w.ground_truth(), w.merchants(), w.customers())


@query
def eda_star(w):
    return _star(w).select("transaction_id", "fraud_label", "merchant_category", "home_country",
                           "country", "amount")


@query
def eda_prevalence(w):
    return eda.prevalence(_star(w))


@query
def eda_rate_by_hour(w):
    return eda.rate_by_hour(_star(w))


@query
def eda_rate_by_category(w):
    return eda.rate_by(_star(w), "merchant_category")


@query
def eda_median_amount(w):
    return eda.median_amount(_star(w).select("fraud_label", "amount"),
                             rows_bound=w.event_count)


@query
def eda_amount_hist(w):
    return eda.amount_histogram(_star(w).select("fraud_label", "amount"))


@query
def eda_flag_lift(w):
    flagged = eda.with_flags(_star(w), w.features)
    return eda.flag_lift(flagged, ["is_new_device", "ip_mismatch", "is_cross_border"])


# ---------------------------------------------------------------- split and metrics

@query
def time_split(w):
    return splits.with_split(w.scored()).select("transaction_id", "split")


@query
def time_split_counts(w):
    return splits.split_counts(splits.with_split(w.scored()))


@query
def class_weights(w):
    return splits.class_weights(w.labelled_scores("train"))


@query
def metric_average_precision(w):
    return metrics.average_precision(w.labelled_scores(), rows_bound=w.event_count)


@query
def metric_average_precision_blocks(w):
    return metrics.average_precision(w.labelled_scores(), one_task_rows=0)


@query
def metric_roc_auc(w):
    return metrics.roc_auc(w.labelled_scores(), rows_bound=w.event_count)


@query
def metric_prf_at_thresholds(w):
    return metrics.threshold_metrics(w.labelled_scores())


@query
def calibration_curve(w):
    return metrics.calibration_curve(w.labelled_scores(), rows_bound=w.event_count)


@query
def candidate_runs(w):
    return w.runs


@query
def candidate_comparison(w):
    return registry.candidate_comparison(w.runs, model.CANDIDATES)


@query
def boosted_champion(w):
    """The better of the two boosted candidates; a tie goes to the first."""
    latest = registry.newest_runs(w.runs)
    return registry.champion(latest, ["xgboost", "lightgbm"]).select("name", "val_pr_auc")


@query
def promotion_gate(w):
    current = registry.newest_runs(w.runs).where("name = 'baseline'")
    return registry.promotion_gate(w.runs.select("name", "run_id", "val_pr_auc"), current)


@query
def trained_runs(w):
    """Runs of the four trained candidates, each judged on every day of the validation span."""
    return w.trained_runs.select(
        "name", "run_id", "start_time", F.col("val_pr_auc").between(0, 1).alias("in_range"))


@query
def trained_comparison(w):
    """Newest run of each trained candidate; the one to deploy has the best figure of all."""
    listed = registry.candidate_comparison(w.trained_runs, model.CANDIDATES)
    best = listed.agg(F.max("val_pr_auc")).scalar()
    return listed.agg(
        F.count("*").alias("candidates"), F.count_if("is_deployed").alias("deployed"),
        F.count_if(F.col("is_deployed") & (F.col("val_pr_auc") == best)).alias("deployed_is_best"),
        F.max(F.substring_index("run_id", "-", -1)).alias("newest_day"), F.min(F.substring_index("run_id", "-", -1)).alias("oldest_day"))


@query
def trained_gate(w):
    """Every trained run before the gate, with the newest baseline in force: who may replace it."""
    current = registry.newest_runs(w.trained_runs).where("name = 'baseline'")
    judged = registry.promotion_gate(w.trained_runs, current)
    bar = current.select("val_pr_auc").scalar()
    return judged.groupBy("name").agg(
        F.count("*").alias("runs"), F.count_if(F.col("may_promote") == (F.col("val_pr_auc") >= bar)).alias("judged_right"))


# ---------------------------------------------------------------- policy and rules

@query
def policy_cost(w):
    return policy.total_cost(w.labelled_scores(), T_REVIEW, T_BLOCK)


@query
def threshold_grid(w):
    return policy.best_thresholds(w.labelled_scores("val"))


@query
def cost_curve(w):
    return policy.cost_curve(w.labelled_scores("val"))


@query
def cost_interpolate(w):
    requests = w.scored().select("transaction_id", F.col("model_score").alias("t"))
    return policy.cost_at(requests, policy.cost_curve(w.labelled_scores("val")))


@query
def rules_eval(w):
    customers, merchants = ["CUST0000007", "CUST0000011"], ["MERC000042"]
    return rules.evaluate_rules(w.features, customers, merchants).select(
        "transaction_id", F.array_join("triggered_rules", ",").alias("triggered_rules"),
        "rule_decision", F.col("is_allowlisted").cast("int").alias("is_allowlisted"))


@query
def rules_allowlist_tables(w):
    """Allowlists given as tables: business customers, and merchants in travel."""
    marked = rules.mark_allowlisted(
        w.features, w.customers().where("customer_segment = 'machinery'"),
        w.merchants().where("merchant_category = 'travel'"))
    return rules.evaluate_rules(marked).groupBy("rule_decision", "is_allowlisted").agg(
        F.count("*").alias("n")).withColumn("is_allowlisted", F.col("is_allowlisted").cast("int"))


@query
def score_bands(w):
    return w.scored().select(
        "transaction_id", rules.score_band("model_score", T_REVIEW, T_BLOCK).alias("band"))


@query
def decide(w):
    return w.decisions.select("transaction_id", "decision", "decision_source")


@query
def decision_records(w):
    return w.build_decisions().select(
        "id", "transaction_id", "model_score", "decision",
        F.array_join("triggered_rules", ",").alias("triggered_rules"), "decision_source",
        "model_run_id", F.col("feature_row.amount").alias("amount"), "created_at")


@query
def policy_model_match(w):
    """The log against a policy of another run, and against one of its own run."""
    out = None
    for run in ("run-other", MODEL_RUN_ID):
        document = policy.policy_document(w.labelled_scores("val"), run)
        line = registry.policy_matches_model(w.decisions, document).withColumns({
            "policy_matches": F.col("policy_matches").cast("int"), "policy_run": F.lit(run)})
        out = line if out is None else out.unionByName(line)
    return out


# ---------------------------------------------------------------- decision log

@query
def decisions_page(w):
    middle = w.transaction_count // 2
    return decisions.page(w.decisions, limit=50, before_id=middle, decision="review").select(
        "id", "transaction_id", "decision", "next_cursor")


@query
def decisions_offset_page(w):
    return decisions.offset_page(w.decisions, 3).select("id", "transaction_id", "decision")


@query
def decisions_stats(w):
    return decisions.stats(w.decisions)


@query
def decisions_stats_window(w):
    return decisions.stats(decisions.since(w.decisions, AS_OF, 60))


@query
def decisions_by_minute(w):
    return decisions.by_minute(w.decisions)


@query
def decisions_pivot(w):
    return decisions.by_minute_wide(w.decisions)


@query
def kpi_cards(w):
    return decisions.kpi_cards(w.decisions, AS_OF)


@query
def log_page(w):
    """The same page from the compacted log, part of which is not compacted yet."""
    middle = w.transaction_count // 2
    return w.log_store.page(50, middle, "review").select("id", "transaction_id", "decision", "next_cursor")


@query
def log_newest_page(w):
    return w.log_store.page(100).select("id", "transaction_id", "next_cursor")


@query
def log_rows(w):
    """All rows of the compacted log and its open batches, one of which was written twice."""
    return w.log_store.read().select("id", "transaction_id", "decision", "model_score", "created_at")


@query
def log_files(w):
    """What the manifest says about the compacted files, against the rows of the log."""
    store = w.log_store
    return store.manifest().agg(
        F.sum("rows").alias("rows"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"),
        F.sum("review_rows").alias("review_rows"),
        F.count_if(F.col("last_id") - F.col("first_id") + 1 != F.col("rows")).alias("files_with_gaps"),
        (F.max(F.lit(len(store.page_files(50, w.transaction_count // 2)))) <= 4).alias("few_files_for_a_page"))


@query
def latest_decision(w):
    """A log in which transactions recur: the same customer's decisions under one key."""
    log = w.decisions.select(
        "id", "created_at", "decision", F.col("feature_row.customer_id").alias("transaction_id"))
    return decisions.latest_per_transaction(log).select(
        "transaction_id", "id", "created_at", "decision")


@query
def decision_times(w):
    """Log times as text with an explicit UTC offset."""
    return w.decisions.select("id", utc_text("created_at").alias("created_at"))


@query
def newest_rows(w):
    return decisions.newest(w.decisions, 500).select("id", "transaction_id", "model_score")


@query
def first_rows(w):
    return decisions.oldest(w.features, 200).select("transaction_id", "amount")


@query
def sample_rows(w):
    return decisions.sample_rows(w.features, 200).select("transaction_id", "amount")


@query
def cyclic_batch(w):
    size = w.transaction_count
    pool = w.features.select("transaction_id", "amount")
    return decisions.cyclic_batch(pool, cursor=size - 10, size=30)


@query
def linear_attribution(w):
    return w.contributions().select("transaction_id", F.inline("contributions"))


@query
def explain_top5(w):
    top = attribution.top_features(k=5)
    return w.contributions().select("transaction_id", F.array_join(
        F.transform(top, lambda x: x["feature"]), ",").alias("top_features"))


def global_importance(w):
    return attribution.global_importance(w.contributions())


# One of the means lies halfway between two six-digit values.
query(global_importance, digits=9)


# ---------------------------------------------------------------- drift and risk

def _drift_sides(w) -> tuple[DataFrame, DataFrame]:
    rows = rounded(w.split_rows())
    return rows.where("split = 'train'"), rows.where("split <> 'train'")


@query
def drift_wasserstein(w):
    a, b = _drift_sides(w)
    return drift.numeric_distances(a, b, rows_bound=w.event_count).select(
        "column", "wasserstein")


@query
def drift_ks(w):
    a, b = _drift_sides(w)
    return drift.numeric_distances(a, b, rows_bound=w.event_count).select("column", "ks")


@query
def drift_ks_blocks(w):
    a, b = _drift_sides(w)
    return drift.numeric_distances(a, b, one_task_rows=0).select("column", "ks")


@query
def drift_far_values(w):
    """Values far from zero, one side moved by one."""
    a = w.raw("orders").select((F.col("o_orderkey") % 2 + 1e9).alias("amount"))
    b = a.select((F.col("amount") + 1).alias("amount"))
    return drift.numeric_distances(a, b, ["amount"]).select("column", "wasserstein", "ks")


@query
def drift_missing_categories(w):
    """Payment methods of which a share is missing, on one side more than on the other."""
    number = F.substring("transaction_id", 4, 10).cast("bigint")
    a, b = (w.features.select(F.when(number % n != 0, F.col("payment_method")).alias("payment_method"))
            for n in (2, 3))
    return drift.categorical_distance(a, b, "payment_method").unionByName(
        drift.categorical_distance(a, a, "payment_method").withColumn("column", F.lit("itself")))


@query
def drift_js(w):
    a, b = _drift_sides(w)
    return drift.categorical_distance(a, b, "payment_method")


@query
def drift_summary(w):
    """All feature rows against the newest 500 scored rows."""
    reference = rounded(w.features)
    current = rounded(quality.newest_payloads(w.decisions, 500))
    report = drift.drift_report(reference, current, rows_bound=w.event_count)
    return drift.drift_summary(report, current)


@query
def drift_tests(w):
    """Every column by the p-value of the test that suits it."""
    a, b = _drift_sides(w)
    return by_column.column_tests(a, b, mode="p_value", rows_bound=w.event_count)


@query
def drift_tests_blocks(w):
    a, b = _drift_sides(w)
    return by_column.column_tests(a, b, mode="p_value", one_task_rows=0)


@query
def drift_tests_summary(w):
    """All feature rows, which are many, against the newest 500 scored rows: distances decide."""
    current = rounded(quality.newest_payloads(w.decisions, 500))
    tests = by_column.column_tests(rounded(w.features), current, mode="distance", rows_bound=w.event_count)
    return by_column.tests_summary(tests, current)


@query
def table_fingerprint(w):
    return risk.fingerprint(w.transactions(), ["transaction_id", "customer_id", "merchant_id",
                                               "device_id", "payment_method", "country"])


@query
def zscore(w):
    scaled = risk.with_zscores(w.features.select("transaction_id", "amount", "device_age_days"),
                               ["amount", "device_age_days"])
    return scaled.select("transaction_id", "z_amount", "z_device_age_days")


def _weighted(w) -> DataFrame:
    """The demonstration model's weights over features on one scale."""
    return risk.weighted_score(w.matrix(), COEFFICIENTS, SCALED)


@query
def latent_risk_score(w):
    return _weighted(w).select("transaction_id", "z")


@query
def prior_shift(w):
    """The intercept that brings those scores to a share of 1.5 %."""
    return risk.prior_shift(_weighted(w), target_rate=0.015)


@query
def exact_quantiles(w):
    """Interpolated quantiles per payment method over the ordered-rank operator."""
    return ordered.exact_quantiles(
        w.features.select("payment_method", "amount"), ["payment_method"], "amount",
        [0.05, 0.5, 0.95], rows_bound=w.event_count)


@query
def exact_quantiles_blocks(w):
    return ordered.exact_quantiles(
        w.features.select("payment_method", "amount"), ["payment_method"], "amount",
        [0.05, 0.5, 0.95], one_task_rows=0)


# ---------------------------------------------------------------- models

@query
def linear_scores(w):
    """Batch scoring with a linear model as a plain column."""
    return w.linear_scored(w.features).select("transaction_id", "model_score")


@query
def baseline_validation(w):
    """Baseline classifier trained on the train split, judged on validation."""
    return w.training_run.validation_metrics


@query
def baseline_test_report(w):
    """The calibrated baseline's metrics on the test split."""
    return w.training_run.test_metrics


@query
def baseline_calibration(w):
    return w.training_run.calibration_curve


@query
def baseline_importances(w):
    return w.training_run.importances


@query
def baseline_policy(w):
    """Thresholds chosen for the stored, reloaded baseline on validation."""
    path = new_shared_path(w.spark, "model")
    w.training_run.deployed.save(path)
    amounts = w.features.select("transaction_id", "amount")
    document = training.choose_policy(path, w.matrix(), amounts, "run-baseline")
    return document.select("t_review", "t_block", "total_cost", "model_run_id",
                           F.size("cost_curve").alias("points"))


@query
def stored_policy(w):
    """What must hold of the policy of a stored model: its cost is what its thresholds cost on the
    validation rows, and no other pair of a coarse grid costs less."""
    path = new_shared_path(w.spark, "model")
    w.training_run.deployed.save(path)
    amounts = w.features.select("transaction_id", "amount")
    chosen = training.choose_policy(path, w.matrix(), amounts, "run-baseline").first()
    scored = durable(model.CalibratedModel.load(path).score(w.matrix().where("split = 'val'")).select(
        "transaction_id", "fraud_label", "model_score").join(amounts, "transaction_id"))
    again = policy.total_cost(scored, chosen["t_review"], chosen["t_block"]).select("total_cost").scalar()
    others = [policy.total_cost(scored, a / 10, b / 10).select("total_cost") for a in range(0, 10, 3) for b in range(a + 1, 11, 3)]
    cheapest = reduce(DataFrame.unionByName, others).agg(F.min("total_cost")).scalar()
    return scored.agg(
        F.count("*").alias("rows"), (F.max(again) == chosen["total_cost"]).alias("cost_of_its_thresholds"),
        (F.max(cheapest) >= chosen["total_cost"]).alias("none_cheaper"),
        F.lit(chosen["t_review"] < chosen["t_block"]).alias("in_order"))


def _test_scores(w, name: str) -> DataFrame:
    run = w.full_run
    return model.with_probability(run.classifier(name), run.part("test")).select(
        "transaction_id", "model_score")


@query
def random_forest_scores(w):
    return _test_scores(w, "random_forest")


@query
def boosted_scores(w):
    return _test_scores(w, "xgboost")


@query
def boosted_second_scores(w):
    return _test_scores(w, "lightgbm")


@query
def tree_attribution(w):
    """Both boosted models explained over the test split: how many rows have contributions that
    add up with the base value to the raw prediction, and how many have five of them on top."""
    run = w.full_run
    rows, out = run.part("test"), None
    for name in ("xgboost", "lightgbm"):
        fitted = run.classifier(name)
        ensemble = model.tree_ensemble(fitted, run.inputs)
        if fitted is ensemble:
            scored = rows.withColumn("raw", trees.raw_score(ensemble))
        else:
            scored = fitted.transform(rows).withColumn("raw", vector_to_array("rawPrediction")[1])
        told = trees.with_tree_contributions(scored.select("transaction_id", *run.inputs, "raw"), ensemble)
        total = F.aggregate("contributions", F.lit(ensemble.expected()), lambda a, c: a + c["value"])
        line = told.agg(
            F.count("*").alias("rows"), F.count_if(F.abs(total - F.col("raw")) < 1e-8).alias("adding_up"),
            F.count_if(F.size(attribution.top_features(k=5)) == 5).alias("with_five")).select(F.lit(name).alias("name"), "*")
        out = line if out is None else out.unionByName(line)
    return out


@query
def tree_decisions(w):
    """Decision records of a deployed boosted model: all of them carry their five reasons."""
    run = w.full_run
    stored = model.calibrate(run.classifier("xgboost"), run.part("val"))
    scored = training.model_scorer(stored, run.inputs, run.background)(w.features)
    records = decisions.decision_records(scored, T_REVIEW, T_BLOCK, "run-trees", top_features=F.col("shap_top_features"))
    return records.agg(
        F.count("*").alias("rows"), F.count_if(F.size("shap_top_features") == 5).alias("explained"),
        F.count_if(F.col("model_score").between(0, 1)).alias("in_range"))


@query
def trained_candidates(w):
    """What must hold of every trained candidate on the test split, from its scores."""
    out = None
    for name in model.CANDIDATES:
        scored = _test_scores(w, name).join(
            w.full_run.part("test").select("transaction_id", "fraud_label"), "transaction_id")
        better = metrics.roc_auc(scored).select((F.col("roc_auc") > 0.5).cast("int")).scalar()
        line = scored.agg(
            F.count("*").alias("rows"), F.sum("fraud_label").alias("positives"),
            F.count_if(F.col("model_score").between(0, 1)).alias("in_range"),
        ).select(F.lit(name).alias("name"), "*", better.alias("better_than_chance"))
        out = line if out is None else out.unionByName(line)
    return out


@query
def trained_choice(w):
    """The candidate to deploy and the better boosted one, against the reported figures."""
    judged = w.full_run.validation_metrics
    best = judged.agg(F.max("val_pr_auc")).scalar()
    boosted = judged.where("name in ('xgboost', 'lightgbm')").agg(F.max("val_pr_auc")).scalar()
    return judged.agg(
        F.count("*").alias("candidates"),
        F.count_if((F.col("name") == w.full_run.deployed_name) & (F.col("val_pr_auc") == best)).alias("deployed_is_best"),
        F.count_if((F.col("name") == w.full_run.champion_name) & (F.col("val_pr_auc") == boosted)).alias("boosted_is_best"))


def calibrated_mean(w):
    """The mean calibrated score on validation, which calibration brings to the prevalence."""
    run = w.training_run
    return run.deployed.score(run.part("val")).agg(
        F.count("*").alias("rows"), F.avg("model_score").alias("mean_score"))


query(calibrated_mean)


def _score_points(w) -> DataFrame:
    """Scores in steps of a hundredth, so that they recur, and what came of the transactions."""
    return w.labelled_scores("val").select(
        F.floor(F.col("model_score") * 100).cast("double").alias("value"), F.col("fraud_label").alias("label"))


def _calibrated_points(w, **limits) -> DataFrame:
    points = _score_points(w)
    fitted = calibration.IsotonicMap.fit(points, **limits)
    return fitted.apply(points.where("value is not null").select("value").distinct(), "value", "calibrated")


@query
def isotonic_map(w):
    """The isotonic fit of the label on the score, at every score there is."""
    return _calibrated_points(w)


@query
def isotonic_map_blocks(w):
    """The same through ranges of a few points that are pooled and merged in rounds."""
    return _calibrated_points(w, range_rows=6)


def baseline_residual(w):
    """Class-weighted residuals of the logistic model on train; its intercept brings them to 0."""
    run = w.training_run
    scored = model.with_probability(run.classifier("baseline"), run.part("train"))
    weighted = model._weighted(scored, balanced=True)
    # Balanced weights add up to the number of rows, and so each class to half of it.
    return weighted.agg(
        F.sum(F.col("__weight") * F.col("fraud_label")).alias("weighted_positives"),
        F.sum(F.col("__weight") * F.col("model_score")).alias("weighted_scores"))


query(baseline_residual, digits=1)


@query
def stored_model_again(w):
    """A stored model, loaded and judged again: the same figures as in its run."""
    path = new_shared_path(w.spark, "model")
    run = w.training_run
    run.deployed.save(path)
    again = training.re_evaluate(path, run.matrix)["validation"]
    then = metrics.evaluate(run.deployed.score(run.part("val")).select("model_score", "fraud_label"))
    return again.select(F.lit("again").alias("time"), "pr_auc", "roc_auc").unionByName(
        then.select(F.lit("then").alias("time"), "pr_auc", "roc_auc")).agg(
        F.count_distinct(F.round("pr_auc", 9)).alias("figures"),
        F.count_if(F.col("roc_auc") > 0.5).alias("better_than_chance"))


@query
def anomaly_mean(w):
    """How many test rows the isolation forest scores, and whether all lie inside (0, 1)."""
    return w.training_run.anomaly_scores.agg(
        F.count("*").alias("rows"), F.count_if(F.expr("anomaly_score > 0 and anomaly_score < 1")).alias("inside"),
        F.count_if(F.col("anomaly_score").isNull()).alias("missing"))


@query
def anomaly_flags(w):
    """Training rows beyond the cut-off that leaves the given share of them above it."""
    run = w.training_run
    scored = durable(anomaly.score(run.part("train"), run.forest, run.inputs).select("transaction_id", "anomaly_score"))
    cut = anomaly.cut_off(scored, rows_bound=w.event_count)
    out = anomaly.flagged(scored, cut)
    return out.agg(
        F.count("*").alias("rows"), (F.sum("is_anomaly") <= F.ceil(anomaly.CONTAMINATION * F.count("*"))).alias("share_kept"),
        F.count_if((F.col("is_anomaly") == 1) & (F.col("anomaly_score") <= cut)).alias("flagged_below"),
        (F.sum("is_anomaly") > 0).alias("some_flagged"))


@query
def deployed_comparison(w):
    """What is stored beside the deployed model for later comparisons, read back."""
    path = new_shared_path(w.spark, "model")
    run = w.training_run
    run.deployed.save(path)
    document = training.enrich(path, run.matrix)
    then = metrics.evaluate(run.deployed.score(run.part("val")).select("model_score", "fraud_label")).select("pr_auc").scalar()
    test_rows = run.part("test").agg(F.count("*")).scalar()
    values = F.transform("importances", lambda x: x["mean_abs_contribution"])
    return document.select(
        w.spark.read.parquet(f"{path}/background").agg(F.count("*")).scalar().alias("background_rows"),
        F.size("importances").cast("bigint").alias("importances"),
        (values == F.reverse(F.array_sort(values))).alias("largest_first"),
        (F.aggregate("calibration_curve", F.lit(0).cast("bigint"), lambda n, x: n + x["rows"]) == test_rows).alias("curve_covers_test"),
        (F.abs(F.col("val_pr_auc") - then) < 1e-9).alias("same_validation"))


@query
def json_array_source(w):
    """All feature rows written as documents of one JSON array each, and read back."""
    path = new_shared_path(w.spark, "array")
    rows = w.wire_rows().select("transaction_id", "amount", "txn_count_24h")
    sinks.write_json_arrays(rows, path, "transaction_id")
    return w.spark.read.schema(rows.schema).option("multiLine", True).json(path)


@query
def stream_minute_counts(w):
    """Decisions per minute and outcome over the streamed log, which comes in the order of time.
    The state holds the last minutes only; each start of the stream goes on from its checkpoint."""
    log, _ = w.stream_paths
    rows = w.spark.read.parquet(log).select(
        "decision", F.col("feature_row.timestamp").cast("timestamp").alias("created_at"))
    out, checkpoint = (new_shared_path(w.spark, n) for n in ("minutes", "stream"))
    w.drained(rows, "created_at", lambda stream: velocity.drain(
        rollup.minute_counts(stream), rollup.upsert_counts(out), checkpoint, mode="update"))
    return rollup.read_counts(w.spark, out)


@query
def stream_velocity(w):
    """Trailing counts from keyed state on a stream of transactions, across restarts."""
    rows = w.transactions().select("transaction_id", "customer_id", "timestamp")
    out, checkpoint = (new_shared_path(w.spark, n) for n in ("velocity", "stream"))
    w.drained(rows, "timestamp", lambda stream: velocity.drain(
        velocity.velocity_counts(stream), lambda part, n: sinks.append_batch(part, out, "velocity", n), checkpoint))
    return w.spark.read.parquet(out).select("transaction_id", "txn_count_1h", "txn_count_24h")


@query
def rollup_stats(w):
    """Monitoring totals read from the batches' summaries instead of the log."""
    return rollup.stats(rollup.read_summary(w.spark, w.summary_path))


@query
def rollup_stats_window(w):
    parts = rollup.read_summary(w.spark, w.summary_path)
    return rollup.stats(rollup.since(parts, w.decisions, AS_OF, 60))


@query
def rollup_by_minute(w):
    return rollup.by_minute(rollup.read_summary(w.spark, w.summary_path))


@query
def rollup_pivot(w):
    return rollup.by_minute_wide(rollup.read_summary(w.spark, w.summary_path))


@query
def rollup_kpi_cards(w):
    """The time limit lies inside a minute."""
    return rollup.kpi_cards(rollup.read_summary(w.spark, w.summary_path), w.decisions, "2024-01-30 12:00:31")


@query
def anomaly_score(w):
    rows = w.matrix()
    inputs = training.inputs_of(rows)
    forest = durable(anomaly.train(rows.where("split = 'train'"), inputs))
    return anomaly.score(rows, forest, inputs).select("transaction_id", "anomaly_score")


# ---------------------------------------------------------------- sinks and streams

@query
def parquet_round_trip(w):
    path = new_shared_path(w.spark, "table")
    sinks.write_parquet(w.features, f"{path}/features.parquet")
    return tables.read_entity(w.spark, path, "features")


@query
def csv_round_trip(w):
    rows = w.scored().select("transaction_id", "model_score")
    path = new_shared_path(w.spark, "csv")
    sinks.write_csv(rows, path)
    return tables.read_csv(w.spark, path, rows.schema)


@query
def json_round_trip(w):
    """Feature rows as JSON messages and back to typed rows."""
    path = new_shared_path(w.spark, "messages")
    sinks.publish_files(w.wire_rows(), path)
    parsed = tables.parse_feature_rows(w.spark.read.text(path))
    return parsed.select("transaction_id", "amount", "txn_count_24h", "device_age_days")


@query
def policy_document(w):
    """The policy written as a JSON document and read back."""
    path = new_shared_path(w.spark, "policy")
    document = policy.policy_document(w.labelled_scores("val"), "run-demo")
    sinks.write_json(document, path)
    stored = w.spark.read.schema(
        "t_review double, t_block double, total_cost double, model_run_id string,"
        " cost_curve array<struct<t_review: double, cost: double>>").json(path)
    return stored.select("t_review", "t_block", "total_cost", "model_run_id",
                         F.size("cost_curve").alias("points"),
                         F.element_at("cost_curve", 1)["cost"].alias("first_cost"))


@query
def stream_decisions(w):
    """The decision log written by the stream."""
    log, _ = w.stream_paths
    return w.spark.read.parquet(log).select(
        "transaction_id", "model_score", "decision", "decision_source",
        F.array_join("triggered_rules", ",").alias("triggered_rules"))


@query
def stream_repeated_batch(w):
    """The last batch of the stream run once more: ids and rows of the log stay as they were."""
    log, _ = w.stream_paths
    rows = w.spark.read.parquet(log)
    last = rows.agg(F.max_by(F.struct("stream", "batch_id"), "batch_id").alias("last"), F.max("id").alias("largest")).first()
    last, largest = last["last"], last["largest"]
    batch = rows.where(F.col("batch_id") == last["batch_id"]).select("feature_row.*").withColumn(
        "timestamp", F.col("timestamp").cast("string"))
    first_id = scoring.next_id(w.spark, log, last["stream"], last["batch_id"])
    again, _ = scoring.score_batch(durable(batch), w.linear_scored, T_REVIEW, T_BLOCK, MODEL_RUN_ID, first_id)
    sinks.append_batch(again, log, last["stream"], last["batch_id"])
    after = w.spark.read.parquet(log).agg(F.count("*").alias("rows"), F.max("id").alias("largest"),
                                          F.count_distinct("id").alias("ids"))
    return after.select("rows", "ids", (F.col("largest") == largest).cast("int").alias("same_largest"),
                        (F.col("ids") == F.col("largest") + 1).cast("int").alias("without_gap"))


@query
def stream_rejected(w):
    _, rejected = w.stream_paths
    return w.spark.read.parquet(rejected).select("transaction_id", "txn_count_24h")


@query
def stream_batch_counts(w):
    """Scored and skipped rows over all batches of the stream."""
    log, rejected = (w.spark.read.parquet(p) for p in w.stream_paths)
    return scoring.batch_counts(log, rejected).agg(
        F.sum("scored").alias("scored"), F.sum("skipped").alias("skipped"))


@query
def stream_log_stats(w):
    """Monitoring figures over the streamed log."""
    log, _ = w.stream_paths
    return decisions.stats(w.spark.read.parquet(log))
