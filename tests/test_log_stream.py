from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import decisions as d
from riskloom.operators import eda
from riskloom.sources import sinks, tables
from riskloom.streaming import scoring
from test_quality_drift import GOOD, feature_rows
from util import at, by_id


def log(spark, n=5):
    rows = [(i, f"TXN{i % 3}", ["approve", "review", "block"][i % 3], i / 10, at(minutes=i))
            for i in range(n)]
    return spark.createDataFrame(
        rows, "id bigint, transaction_id string, decision string, model_score double,"
              " created_at timestamp_ntz")


def test_pages_are_disjoint_and_newest_first(spark):
    rows = log(spark)
    first = d.page(rows, limit=2).collect()
    assert [r.id for r in first] == [4, 3] and first[0].next_cursor == 3
    second = d.page(rows, limit=2, before_id=3).collect()
    assert [r.id for r in second] == [2, 1] and second[0].next_cursor == 1
    last = d.page(rows, limit=2, before_id=1).collect()
    assert [r.id for r in last] == [0] and last[0].next_cursor is None
    assert [r.id for r in d.page(rows, limit=0).collect()] == [4]
    assert [r.id for r in d.page(rows, decision="review").collect()] == [4, 1]
    assert [r.id for r in d.offset_page(rows, 1, size=2).collect()] == [2, 1]


def test_monitoring_figures(spark):
    rows = log(spark)
    assert tuple(d.stats(rows).first()) == (5, 2, 2, 1, pytest.approx(0.2))
    assert tuple(d.stats(rows.limit(0)).first()) == (0, 0, 0, 0, 0.0)
    recent = d.since(rows, at(minutes=4), 2)
    assert [r.id for r in recent.orderBy("id").collect()] == [2, 3, 4]
    assert [tuple(r) for r in d.by_minute(recent).collect()] == [
        ("2024-03-01T00:02", "block", 1), ("2024-03-01T00:03", "approve", 1),
        ("2024-03-01T00:04", "review", 1)]
    wide = d.by_minute_wide(rows).first()
    assert tuple(wide) == ("2024-03-01T00:00", 1, 0, 0)
    cards = {r.decision: (r.all_time, r.recent) for r in d.kpi_cards(rows, at(minutes=4), 2).collect()}
    assert cards == {"approve": (2, 1), "review": (2, 1), "block": (1, 1)}


def test_latest_decision(spark):
    got = by_id(d.latest_per_transaction(log(spark)))
    assert {k: r.id for k, r in got.items()} == {"TXN0": 3, "TXN1": 4, "TXN2": 2}
    assert d.investigation(log(spark), "TXN1").first().id == 4
    assert d.investigation(log(spark), "none").count() == 0


def test_samples_are_exact_and_repeatable(spark):
    rows = log(spark, 50).withColumn("transaction_id", F.col("id").cast("string"))
    a = {r.id for r in d.sample_rows(rows, 10).collect()}
    b = {r.id for r in d.sample_rows(rows.repartition(7), 10).collect()}
    assert a == b and len(a) == 10 and a != {r.id for r in d.sample_rows(rows, 10, seed=1).collect()}
    assert d.sample_rows(rows, 500).count() == 50


@pytest.mark.parametrize("limits", [{}, {"one_task_rows": 0}], ids=["one task", "blocks"])
def test_cyclic_batches_wrap(spark, limits):
    pool = spark.createDataFrame([(f"p{i}",) for i in range(5)], "transaction_id string")
    got = d.cyclic_batch(pool, 3, 4, **limits).orderBy("slot").collect()
    assert [r.transaction_id for r in got] == ["p3", "p4", "p0", "p1"]
    assert {r.next_cursor for r in got} == {2}
    long = d.cyclic_batch(pool, 4, 7, **limits).orderBy("slot").collect()
    assert [r.transaction_id for r in long] == ["p4", "p0", "p1", "p2", "p3", "p4", "p0"]
    assert d.cyclic_batch(pool.limit(0), 3, 4).count() == 0


def test_histogram_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    y, a = (rng.random(400) < 0.2).astype(int), np.round(rng.gamma(1, 400, 400), 2)
    rows = spark.createDataFrame([(int(k), float(v)) for k, v in zip(y, a)],
                                 "fraud_label int, amount double")
    got = {(r.fraud_label, r.bin): r.n for r in eda.amount_histogram(rows).collect()}
    for label in (0, 1):
        counts, _ = np.histogram(np.minimum(a[y == label], 1000), bins=50)
        assert [got.get((label, i), 0) for i in range(50)] == counts.tolist()


def scorer(rows):
    return rows.withColumn("model_score", F.col("amount") / 100)


def wire(spark, rows):
    return rows.withColumn("timestamp", F.col("timestamp").cast("string"))


def test_stream_scores_skips_and_repeats_without_duplicates(spark, tmp_path):
    topic, out, bad, check = (str(tmp_path / n) for n in ("topic", "log", "bad", "check"))
    rows = feature_rows(
        spark, dict(transaction_id="TXN1", amount=90.0),
        dict(transaction_id="TXN2", amount=None), dict(transaction_id="TXN3", amount=5.0),
        dict(transaction_id="TXN4", is_night=7))
    sinks.publish_files(wire(spark, rows), topic, files=1)
    with open(f"{topic}/z.txt", "w") as extra:
        extra.write("not json\n" + json.dumps({**GOOD, "transaction_id": "TXN5",
                                               "timestamp": "whenever"}) + "\n")

    def run(checkpoint=check):
        query = scoring.score_stream(tables.read_file_stream(spark, topic), scorer, 0.3, 0.7,
                                     "run", out, bad, checkpoint)
        query.awaitTermination()

    run()
    counts = scoring.batch_counts(spark.read.parquet(out), spark.read.parquet(bad))
    assert [tuple(r)[1:] for r in counts.collect()] == [(0, 2, 4)]
    stream = counts.first().stream
    got = by_id(spark.read.parquet(out))
    assert {k: (r.decision, r.decision_source) for k, r in got.items()} == {
        "TXN1": ("block", "model"), "TXN3": ("approve", "model")}
    assert got["TXN1"].feature_row.amount == 90.0 and got["TXN1"].model_run_id == "run"
    assert spark.read.parquet(bad).count() == 4
    run()  # nothing new
    assert spark.read.parquet(out).count() == 2
    # A batch that is run again replaces what it wrote.
    records, _ = scoring.score_batch(wire(spark, rows), scorer, 0.3, 0.7, "run", 0)
    sinks.append_batch(records, out, stream, 0)
    sinks.append_batch(records, out, stream, 0)
    assert spark.read.parquet(out).count() == 2
    # New messages continue the log with higher ids.
    sinks.publish_files(wire(spark, feature_rows(spark, dict(transaction_id="TXN9"))), topic)
    run()
    ids = by_id(spark.read.parquet(out))
    assert ids["TXN9"].id > max(ids["TXN1"].id, ids["TXN3"].id)
    # A lost checkpoint scores the topic again; the earlier log stays, ids go on rising.
    run(str(tmp_path / "other"))
    log_rows = spark.read.parquet(out).select("stream", "transaction_id", "id").collect()
    old, new = ([r for r in log_rows if (r.stream == stream) is same] for same in (True, False))
    assert len(old) == len(new) == 3
    assert min(r.id for r in new) > max(r.id for r in old)


def test_scorer_errors_fail_the_batch_and_write_nothing(spark, tmp_path):
    topic, out, bad, check = (str(tmp_path / n) for n in ("topic", "log", "bad", "check"))
    sinks.publish_files(wire(spark, feature_rows(spark, {})), topic)

    def broken(rows):
        return rows.withColumn("model_score", F.raise_error(F.lit("no model")).cast("double"))

    query = scoring.score_stream(tables.read_file_stream(spark, topic), broken, 0.3, 0.7, "run",
                                 out, bad, check)
    with pytest.raises(Exception, match="no model"):
        query.awaitTermination()
    again = scoring.score_stream(tables.read_file_stream(spark, topic), scorer, 0.3, 0.7, "run",
                                 out, bad, check)
    again.awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_readers_and_writers(spark, tmp_path):
    rows = feature_rows(spark, {}, dict(transaction_id="TXN2", amount=7.5))
    sinks.write_parquet(rows, str(tmp_path / "features.parquet"))
    assert tables.read_entity(spark, str(tmp_path), "features").exceptAll(rows).count() == 0
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert tables.read_csv(spark, str(tmp_path / "csv"), S.FEATURES).exceptAll(rows).count() == 0
    pool = [{**GOOD, "timestamp": "2024-03-01T00:00:00"}] * 2
    (tmp_path / "pool.json").write_text(json.dumps(pool))
    read = tables.read_json_pool(spark, str(tmp_path / "pool.json"))
    assert read.count() == 2 and read.first().is_night == 1
    assert scoring.typed(read).first().timestamp == at()
    assert [f.name for f in S.FEATURE_WIRE] == S.FEATURE_COLUMNS
    assert all(S.FEATURE_WIRE[c].dataType.simpleString() == "int" for c in S.FLAG_COLUMNS)
    options = tables.kafka_options("host:1", {"kafka.ssl.truststore.type": "PEM"})
    assert options["kafka.security.protocol"] == "SSL"


def test_json_arrays_hold_all_rows_in_bounded_documents(spark, tmp_path):
    rows = spark.range(1000).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), F.when(F.col("id") % 7 > 0, F.col("id") / 8).alias("amount"))
    path = tmp_path / "arrays"
    sinks.write_json_arrays(rows, str(path), "transaction_id", size=50)
    sizes = [len(json.loads(p.read_text())) for p in path.glob("part-*") if p.stat().st_size]
    assert sum(sizes) == 1000 and len(sizes) == 20 and max(sizes) < 100
    read = spark.read.schema(rows.schema).option("multiLine", True).json(str(path))
    assert read.exceptAll(rows).count() == 0 and read.count() == 1000
    sinks.write_json_arrays(rows.limit(0), str(path), "transaction_id")
    assert spark.read.schema(rows.schema).option("multiLine", True).json(str(path)).count() == 0


def test_json_array_source_writes_every_row(small, monkeypatch):
    from riskloom.plans import queries
    written = []
    plain = sinks.write_json_arrays
    monkeypatch.setattr(sinks, "write_json_arrays", lambda rows, path, key: (written.append(rows.count()), plain(rows, path, key, 100)))
    read = queries.QUERIES["json_array_source"](small.spark, "/root/testdata/sf0.001")
    rows = small.wire_rows().select(*read.columns)
    assert written == [rows.count()] and len(read.inputFiles()) > 1
    assert read.exceptAll(rows).count() == 0 and read.count() == rows.count()


def test_messages_are_published_in_bounded_files_without_moving_rows(spark, tmp_path):
    rows = spark.range(0, 25, 1, 3).select(F.col("id").alias("n"))
    sinks.publish_files(rows, str(tmp_path), file_rows=4, compression="gzip")
    parts = spark.read.text(str(tmp_path)).select(
        F.input_file_name().alias("file"), F.get_json_object("value", "$.n").cast("int").alias("n"))
    files = parts.groupBy("file").agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).collect()
    assert sum(f.rows for f in files) == 25 and max(f.rows for f in files) <= 4
    assert all(f.high - f.low + 1 == f.rows and f.file.endswith(".gz") for f in files)
    assert sorted(r.n for r in parts.collect()) == list(range(25))


def test_repeated_batch_is_copied_once(small, monkeypatch):
    from riskloom.plans import queries

    copies, durable = [], queries.durable
    monkeypatch.setattr(queries, "durable", lambda df: copies.append(df) or durable(df))
    got = queries.QUERIES["stream_repeated_batch"](small.spark, small.data_dir).first()
    assert got["rows"] == got["ids"] > 0 and got["same_largest"] == got["without_gap"] == 1
    assert len(copies) == 1
