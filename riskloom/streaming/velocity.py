"""Trailing transaction counts on a stream, with one state per customer and event-time timers.

The state of a customer is the distinct instants of its last day with their counts. Two
modes:

- on arrival: a row leaves in the batch that brings it, with the counts of what was known by
  then. Equal to the batch feature as long as rows come in the order of time.
- held: a row waits until the watermark has passed its instant. Within the allowed delay the
  counts are then those of the batch feature whatever the order of arrival.

Instants that no row still to come can look back to are forgotten, and a timer a day after the last
instant drops the state of a customer without further rows, so the state follows the number of
recently active customers, not the length of the stream. Rows behind the watermark are dropped by
Spark and counted in the progress of the query (``late_rows``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from riskloom.operators.features import DAY_US, HOUR_US
from riskloom.operators.ordered import micros

COUNTS = "transaction_id string, customer_id string, timestamp timestamp, txn_count_1h bigint, txn_count_24h bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class _Velocity(StatefulProcessor):
    def __init__(self, hold: bool) -> None:
        self.hold = hold

    def init(self, handle) -> None:
        self.handle = handle
        # A day of instants, ascending, how many rows each has, and whether a timer to forget them is set.
        # Every call to the state is a round trip, so one value holds it all.
        self.day = handle.getValueState("day", "instants array<bigint>, counts array<bigint>, timer boolean")
        self.waiting = handle.getListState("waiting", "us bigint, transaction_id string")

    def _history(self) -> tuple[np.ndarray, np.ndarray, bool]:
        found = self.day.get()
        if found is None:
            return np.empty(0, np.int64), np.empty(0, np.int64), False
        instants, counts, timer = found
        return np.array(instants, dtype=np.int64), np.array(counts, dtype=np.int64), timer

    def _set_timer(self, at_ms: int) -> None:
        """One timer at a time."""
        for old in [t[0] if isinstance(t, tuple) else t for t in self.handle.listTimers()]:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at_ms)

    def _counted(self, customer: str, us: np.ndarray, ids: list, known: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
        """Rows with the counts of [t - width, t) among the known instants."""
        instants, counts = known
        before = np.concatenate([[0], np.cumsum(counts)])
        until = before[np.searchsorted(instants, us, side="left")]
        out = {"transaction_id": ids, "customer_id": customer, "timestamp": us.astype("datetime64[us]")}
        for name, width in (("txn_count_1h", HOUR_US), ("txn_count_24h", DAY_US)):
            out[name] = until - before[np.searchsorted(instants, us - width, side="left")]
        return pd.DataFrame(out)

    def _remember(self, known: tuple[np.ndarray, np.ndarray], watermark_us: int, timer: bool = False, forget: bool = False) -> None:
        """Store what rows at or after the watermark can look back to. With ``forget`` a timer a day after
        the last instant is set, unless one is: that one looks again when it comes."""
        instants, counts = known
        needed = instants >= watermark_us - DAY_US
        instants, counts = instants[needed], counts[needed]
        if len(instants):
            if forget and not timer:
                self.handle.registerTimer((int(instants[-1]) + DAY_US) // 1000 + 1)
                timer = True
            self.day.update((instants.tolist(), counts.tolist(), timer))
        else:
            self.day.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        batch = parts[0] if len(parts) == 1 else pd.concat(parts)
        us, ids = batch["us"].to_numpy(np.int64), batch["transaction_id"].tolist()
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        instants, counts, timer = self._history()
        merged, place = np.unique(np.concatenate([instants, us]), return_inverse=True)
        known = merged, np.bincount(place, np.concatenate([counts, np.ones(len(us))]), len(merged)).astype(np.int64)
        if not self.hold:
            self._remember(known, watermark, timer, forget=True)
            yield self._counted(key[0], us, ids, known)
            return
        self.waiting.appendList([(int(t), i) for t, i in zip(us, ids)])
        # Rows that wait look back a day from their own instant, and none is behind the watermark.
        self._remember(known, watermark)
        self._set_timer(min(t for t, _ in self.waiting.get()) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        known = self._history()[:2]
        waiting = list(self.waiting.get()) if self.hold and self.waiting.exists() else []
        # Nothing more can come before the watermark, so the counts of these rows are final.
        ready = [w for w in waiting if w[0] <= watermark]
        rest = [w for w in waiting if w[0] > watermark]
        oldest = min([watermark, *[w[0] for w in rest]])
        if ready:
            yield self._counted(key[0], np.array([w[0] for w in ready], dtype=np.int64), [w[1] for w in ready], known)
        if rest:
            self.waiting.put([tuple(w) for w in rest])
        elif waiting:
            self.waiting.clear()
        self._remember(known, oldest, forget=not rest)
        if rest:
            self._set_timer(min(w[0] for w in rest) // 1000 + 1)

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession):
    """Stateful operators with timers need the RocksDB store; a query keeps what it starts with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def velocity_counts(transactions: DataFrame, delay: str = "10 minutes", hold: bool = False) -> DataFrame:
    """``txn_count_1h`` and ``txn_count_24h`` of a stream of transactions, in append mode.

    ``timestamp`` is the event time; rows may come up to ``delay`` behind the newest one. A row
    without a customer or an instant has no history; it is left out here, as is one that comes later than allowed.
    """
    rows = transactions.select(
        "transaction_id", "customer_id", F.col("timestamp").cast("timestamp").alias("timestamp"),
        micros("timestamp").alias("us"))
    return (
        rows.where("customer_id is not null and timestamp is not null").withWatermark("timestamp", delay)
        .groupBy("customer_id")
        .transformWithStateInPandas(_Velocity(hold), COUNTS, outputMode="Append", timeMode="EventTime")
    )


def drain(rows: DataFrame, write, checkpoint_path: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over what its source holds now. ``write`` takes (rows, batch number) and must
    replace what an earlier attempt at the same batch has written."""
    with keyed_state(rows.sparkSession):
        query = (
            rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).foreachBatch(write).start())
        query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, over the reported batches of a query."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """Rows of state that the last batch of a query left."""
    last = query.lastProgress
    return sum(op["numRowsTotal"] for op in last["stateOperators"]) if last else 0
