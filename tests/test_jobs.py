from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.__main__ import main
from riskloom.functions.scalar import utc_text
from riskloom.operators import quality
from riskloom.sources import sinks


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The canonical tables in their declared form, in one data folder."""
    folder = tmp_path_factory.mktemp("data")
    frames = {n: getattr(small, n)() for n in (
        "transactions", "customers", "devices", "merchants", "ground_truth")}
    for name, df in frames.items():
        full = df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.ENTITIES[name]])
        sinks.write_parquet(full, f"{folder}/{name}.parquet")
    return folder


def test_jobs_end_to_end(spark, small, stored, capsys):
    d = str(stored)
    main(["features", "--data-dir", d], spark)
    assert "wrote 1000 rows" in capsys.readouterr().out
    main(["train", "--data-dir", d, "--model-dir", f"{d}/model", "--rounds", "2", "--trees", "5"],
         spark)
    assert "deployed" in capsys.readouterr().out
    main(["thresholds", "--data-dir", d, "--model-dir", f"{d}/model", "--output", f"{d}/policy",
          "--run-id", "r1"], spark)
    policy = spark.read.json(f"{d}/policy").first()
    assert policy.model_run_id == "r1" and policy.t_review < policy.t_block
    wire = small.features.withColumn("timestamp", F.col("timestamp").cast("string"))
    sinks.publish_files(wire, f"{d}/topic", files=2)
    main(["stream", "--data-dir", d, "--model-dir", f"{d}/model", "--thresholds", f"{d}/policy",
          "--run-id", "r1", "--log", f"{d}/log", "--rejected", f"{d}/bad", "--checkpoint",
          f"{d}/check", "--topic-dir", f"{d}/topic"], spark)
    log = spark.read.parquet(f"{d}/log")
    assert log.count() == 1000 and log.select("id").distinct().count() == 1000
    main(["check-log", "--log", f"{d}/log"], spark)
    assert "checked 500 rows: passed" in capsys.readouterr().out
    main(["drift", "--data-dir", d, "--log", f"{d}/log"], spark)
    printed = capsys.readouterr().out
    assert "wasserstein" in printed and "kolmogorov_smirnov" in printed
    assert spark.read.parquet(f"{d}/model/background").count() == 100
    for batch in range(2):
        sinks.append_batch(log.where(F.col("id") % 2 == batch).drop("stream", "batch_id"), f"{d}/store/batches", "s", batch)
    for said in ("generation 1\n", "generation 1, nothing new\n"):
        main(["compact", "--store", f"{d}/store"], spark)
        assert capsys.readouterr().out == said


def test_check_log_fails_on_bad_rows(spark, tmp_path, capsys):
    from test_quality_drift import _log

    _log(spark, {}, dict(amount=-1.0)).write.parquet(str(tmp_path / "log"))
    with pytest.raises(SystemExit):
        main(["check-log", "--log", str(tmp_path / "log")], spark)
    assert "amount: greater_than(0) failed 1 times" in capsys.readouterr().out


def test_times_carry_an_offset(spark):
    rows = spark.sql("select timestamp_ntz'2024-03-01 10:00:00' as t union all"
                     " select timestamp_ntz'2024-03-01 10:00:00.25'")
    assert sorted(r[0] for r in rows.select(utc_text("t")).collect()) == [
        "2024-03-01T10:00:00+00:00", "2024-03-01T10:00:00.250000+00:00"]


def test_every_query_has_rows_and_most_have_an_oracle():
    import __spark_entry__ as entry
    from riskloom.plans.oracles import ORACLES
    from riskloom.plans.queries import QUERIES

    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    names, oracles = set(QUERIES), set(ORACLES)
    assert oracles <= names
    assert names - oracles == {
        "baseline_validation", "baseline_test_report", "baseline_calibration",
        "baseline_importances", "baseline_policy", "random_forest_scores", "boosted_scores", "boosted_second_scores",
        "anomaly_score"}


def test_references_hold_on_the_stored_tables(spark, small, stored):
    assert quality.orphans(small.transactions(), small.customers(), "customer_id").count() == 0
    assert quality.device_owner_mismatch(small.transactions(), small.devices()).count() == 0
    assert quality.confirmed_before_transaction(
        small.transactions(), small.ground_truth()).count() == 0
