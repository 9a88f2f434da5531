"""Stateful streams: trailing counts by customer, minute counts with eviction."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import decisions, features
from riskloom.sources.sinks import append_batch
from riskloom.streaming import rollup, velocity
from util import at

SCHEMA = "transaction_id string, customer_id string, timestamp timestamp_ntz"


class Feed:
    """A folder that grows file by file, and a stream over it."""

    def __init__(self, spark, path, hold=False, delay="10 minutes"):
        self.spark, self.path, self.hold, self.delay = spark, path, hold, delay
        self.number = 0

    def add(self, rows):
        frame = self.spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(f"{self.path}/in")

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.path}/in")
        out = f"{self.path}/out"
        return velocity.drain(velocity.velocity_counts(stream, self.delay, self.hold),
                              lambda rows, n: append_batch(rows, out, "s", n), f"{self.path}/checkpoint")

    def result(self):
        return {r.transaction_id: (r.txn_count_1h, r.txn_count_24h) for r in self.spark.read.parquet(f"{self.path}/out").collect()}


def batch_counts(spark, rows):
    frame = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], SCHEMA)
    return {r.transaction_id: (r.txn_count_1h, r.txn_count_24h) for r in features.velocity_features(frame).collect()}


def history(n=120, seed=3):
    """Rows in the order of time: ties, edges of the windows, idle days."""
    rng, now, rows = random.Random(seed), 0, []
    for i in range(n):
        now += rng.choice([0, 0, 60, 600, 3600, 3601, 7200, 86_400 if i % 17 == 0 else 30])
        rows.append((f"T{i}", f"C{rng.randint(0, 3)}", at(seconds=now)))
    return rows


def test_counts_on_arrival_equal_the_batch_feature(spark, tmp_path):
    rows, feed = history(), Feed(spark, tmp_path)
    for s in range(0, len(rows), 40):  # each run goes on from the checkpoint
        feed.add(rows[s:s + 40])
        query = feed.run()
        assert velocity.late_rows(query) == 0
    feed.run()
    assert feed.result() == batch_counts(spark, rows)


def test_held_rows_are_right_in_any_order(spark, tmp_path):
    rows = history(90)
    mixed = rows[:]
    random.Random(1).shuffle(mixed)
    feed = Feed(spark, tmp_path, hold=True, delay="30 days")
    for s in range(0, len(mixed), 45):
        feed.add(mixed[s:s + 45])
        feed.run()
    assert feed.result() == {}  # all within the delay
    feed.add([("beat", "nobody", at(days=100))])
    feed.run()
    assert feed.result() == batch_counts(spark, rows)


def test_idle_customers_leave_the_state_and_late_rows_are_counted(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(f"a{i}", f"C{i}", at(minutes=i)) for i in range(30)])
    busy = velocity.state_rows(feed.run())
    feed.add([("b", "C0", at(days=3))])
    feed.run()
    feed.add([("c", "C0", at(days=3, hours=1)), ("late", "C1", at(minutes=40))])
    query = feed.run()
    assert velocity.late_rows(query) == 1 and busy >= 30
    assert velocity.state_rows(query) < busy / 4
    got = feed.result()
    assert got["b"] == (0, 0) and got["c"] == (1, 1) and "late" not in got and len(got) == 32


def test_rows_without_customer_or_instant_are_left_out(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([("a", None, at()), ("b", "C1", None), (None, "C1", at()), ("c", "C1", at(hours=1))])
    feed.run()
    assert feed.result() == {None: (0, 0), "c": (1, 1)}


def minutes(spark, n, first=0):
    return spark.createDataFrame(
        [(i, ["approve", "review", "block"][i % 3], 0.1 * (i % 7) if i % 5 else None, at(seconds=40 * i)) for i in range(first, first + n)],
        "id bigint, decision string, model_score double, created_at timestamp_ntz")


def test_minute_counts_leave_the_state(spark, tmp_path):
    """Three starts; closed minutes leave the state, a late row is counted, a batch may be repeated."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = spark.readStream.schema(minutes(spark, 1).schema).parquet(source)
        counts = rollup.minute_counts(stream.withColumn("created_at", F.col("created_at").cast("timestamp")))
        written = []

        def write(rows, n):
            kept = rows.persist()
            for _ in range(2):  # the second time is the repetition
                rollup.upsert_counts(out)(kept, n)
            written.append(n)

        return velocity.drain(counts, write, str(tmp_path / "checkpoint"), mode="update")

    everything = minutes(spark, 300)
    minutes(spark, 150).write.mode("append").parquet(source)
    full = velocity.state_rows(run())
    minutes(spark, 150, 150).write.mode("append").parquet(source)
    assert velocity.late_rows(run()) == 0
    minutes(spark, 3, 5).union(minutes(spark, 1, 299)).write.mode("append").parquet(source)
    late = run()
    # Every decision is a group of its own here, or one of few; the state holds the last ten minutes.
    assert velocity.late_rows(late) == 3
    assert max(full, velocity.state_rows(late)) < decisions.by_minute(everything).count() / 5
    got = rollup.read_counts(spark, out)
    assert got.exceptAll(decisions.by_minute(everything.union(minutes(spark, 1, 299)))).count() == 0
    assert got.agg(F.sum("count")).first()[0] == 301


def test_summaries_equal_the_full_scan(spark, tmp_path):
    path, log = str(tmp_path / "summary"), minutes(spark, 200)
    for number in (0, 1, 2, 1):  # one batch again
        rollup.write_summary(log.where(F.col("id") % 3 == number), path, "s", number)
    parts = rollup.read_summary(spark, path)
    assert rollup.stats(parts).first()[:4] == decisions.stats(log).first()[:4]
    assert rollup.stats(parts).first()[4] == pytest.approx(decisions.stats(log).first()[4])
    assert rollup.by_minute(parts).collect() == decisions.by_minute(log).collect()
    assert rollup.by_minute_wide(parts).collect() == decisions.by_minute_wide(log).collect()
    for seconds in (0, 20, 59):
        as_of = at(minutes=100, seconds=seconds)
        assert sorted(rollup.kpi_cards(parts, log, as_of, 30).collect()) == sorted(decisions.kpi_cards(log, as_of, 30).collect())
        recent = decisions.stats(decisions.since(log, as_of, 30)).first()
        assert rollup.stats(rollup.since(parts, log, as_of, 30)).first()[:4] == recent[:4]
    empty = rollup.stats(rollup.summary(log.limit(0)))
    assert tuple(empty.first()) == (0, 0, 0, 0, 0.0)


class _State:
    """A handle that keeps one customer's state in memory and counts the calls to it."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    getListState = getValueState

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def listTimers(self):
        self.calls += 1
        return iter([(t,) for t in self.timers])

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class _Watermark:
    def __init__(self, us):
        self.ms = us // 1000

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_customer_costs_two_calls_a_batch_and_is_forgotten_in_the_end():
    import pandas as pd

    day, hour, state = features.DAY_US, features.HOUR_US, _State()
    customer = velocity._Velocity(hold=False)
    customer.init(state)

    def arrive(*us, watermark):
        rows = pd.DataFrame({"transaction_id": [str(t) for t in us], "us": us})
        return list(customer.handleInputRows(("C",), iter([rows]), _Watermark(watermark)))[0]

    assert arrive(hour, 2 * hour, watermark=0)["txn_count_24h"].tolist() == [0, 1]
    before = state.calls
    assert arrive(3 * hour, watermark=2 * hour)["txn_count_24h"].tolist() == [2]
    assert state.calls - before == 2 and len(state.timers) == 1
    # The timer was set for the first batch; when it comes, newer instants are kept and it is set again.
    first = state.timers.pop()
    assert list(customer.handleExpiredTimer(("C",), _Watermark(first * 1000), None)) == []
    assert state.value[0] == [3 * hour] and len(state.timers) == 1
    last = state.timers.pop()
    assert last * 1000 > 3 * hour + day
    assert list(customer.handleExpiredTimer(("C",), _Watermark(last * 1000), None)) == []
    assert state.value is None and not state.timers
