"""The compacted log: every row once at any moment, and pages from few files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.operators import decisions
from riskloom.sources.log_store import LogStore
from util import at

SCHEMA = "id bigint, transaction_id string, decision string, model_score double, created_at timestamp_ntz"


def batch(spark, first, n):
    rows = [(i, f"TXN{i % 37}", "block" if i % 50 == 0 else "review" if i % 7 == 0 else "approve", i / 1000, at(minutes=i))
            for i in range(first, first + n)]
    return spark.createDataFrame(rows, SCHEMA)


def state(store):
    rows = store.read().select(*[c.split()[0] for c in SCHEMA.split(", ")])
    return sorted(map(tuple, rows.collect()))


def test_rows_stay_the_same_through_compactions(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "log"), file_rows=30)
    assert store.read() is None and store.page() is None and not store.compact() and store.next_id("a", 0) == 0
    for n in range(3):
        store.append(batch(spark, 20 * n, 20), "a", n)
        assert store.next_id("a", n + 1) == 20 * n + 20
    whole = sorted(map(tuple, batch(spark, 0, 60).collect()))
    assert state(store) == whole
    assert store.compact() and store.generation() == 1 and state(store) == whole and store.open_batches() is None
    files = store.manifest().orderBy("first_id").collect()
    assert len(files) == 2 and all(a.last_id < b.first_id for a, b in zip(files, files[1:])) and sum(f.rows for f in files) == 60
    # A covered batch that is run again changes nothing, nor does the number of its first id.
    store.append(batch(spark, 40, 20), "a", 2)
    assert state(store) == whole and not store.compact() and store.next_id("a", 3) == 60
    with pytest.raises(ValueError, match="compacted already"):
        store.next_id("a", 2)
    # An open batch that is run again replaces its rows; another stream goes on.
    for _ in range(2):
        store.append(batch(spark, 60, 5), "a", 3)
    assert store.next_id("b", 0) == 65
    store.append(batch(spark, 65, 5), "b", 0)
    whole = sorted(map(tuple, batch(spark, 0, 70).collect()))
    assert state(store) == whole and store.compact() and state(store) == whole
    assert store._covered(store.generation()) == {"a": 3, "b": 0}


def test_a_crash_before_the_mark_leaves_the_old_state(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "log"), file_rows=30)
    store.append(batch(spark, 0, 40), "a", 0)
    store.compact()
    store.append(batch(spark, 40, 10), "a", 1)
    before = state(store)
    assert store.write_generation(2)  # and no more
    assert store.generation() == 1 and state(store) == before and store.next_id("a", 2) == 50
    store.append(batch(spark, 50, 10), "a", 2)
    assert store.compact() and store.generation() == 2
    assert state(store) == sorted(map(tuple, batch(spark, 0, 60).collect()))
    with pytest.raises(RuntimeError, match="in force already"):
        store.put_in_force(2)


def test_small_files_grow_together(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "log"), file_rows=100)
    for n in range(6):
        store.append(batch(spark, 10 * n, 10), "a", n)
        store.compact()
    assert store.manifest().count() <= 2 and len(state(store)) == 60


@pytest.mark.parametrize("limit,before_id,decision", [
    (10, None, None), (10, 500, None), (5, 333, "review"), (3, 1000, "block"), (20, 60, "block"), (500, 400, None), (10, 3, None), (10, 0, None)])
def test_pages_equal_the_full_scan_and_open_few_files(spark, long_log, limit, before_id, decision):
    store, everything = long_log
    want = decisions.page(everything, limit, before_id, decision).select("id", "decision", "next_cursor").collect()
    assert store.page(limit, before_id, decision).select("id", "decision", "next_cursor").collect() == want
    rate = {None: 1, "review": 7, "block": 50}[decision]
    assert len(store.page_files(limit, before_id, decision)) <= 3 + (limit + 1) * rate / 40


@pytest.fixture(scope="module")
def long_log(spark, tmp_path_factory):
    store = LogStore(spark, str(tmp_path_factory.mktemp("log")), file_rows=50)
    store.append(batch(spark, 0, 900), "a", 0)
    store.compact()
    store.append(batch(spark, 900, 20), "a", 1)  # still open
    return store, batch(spark, 0, 920)


def test_investigation(long_log):
    store, everything = long_log
    assert store.investigation("TXN5").first().id == everything.where("transaction_id = 'TXN5'").agg(F.max("id")).first()[0]
    assert store.investigation("none").count() == 0


def test_batches_and_compacted_files_are_compressed_with_zstd(spark, tmp_path):
    """What the log writes is compressed with zstd, before and after a compaction."""
    store = LogStore(spark, str(tmp_path / "log"), file_rows=30)
    store.append(batch(spark, 0, 20), "a", 0)
    assert store.compact()
    for folder in ("batches", "files"):
        names = [p.name for p in (tmp_path / "log" / folder).rglob("*.parquet")]
        assert names and all(n.endswith(".zstd.parquet") for n in names)
