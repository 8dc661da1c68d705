"""Structured Streaming counterparts of the weekly run (ST1-ST7)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from signalloom.functions import dates as D

REPLAY_DAYS = 35


def fresh_records(stream: DataFrame, ts: str = "ts", key: str = "id", days: int = REPLAY_DAYS) -> DataFrame:
    """Records seen for the first time within the replay window (ST1); a replay adds nothing."""
    return stream.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark([key])


def upsert_batches(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str):
    """Hand every micro-batch to `merge`; the checkpoint moves on only after it returns (ST2).

    The offset log is the cursor, so a failed batch is replayed and the merge must be keyed.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge(batch, batch_id)
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_offset(as_of: str, days: int, step: int | None = None) -> str:
    """Start offset that makes windows of `days`, one every `step`, end at `as_of`."""
    seconds = (int(pd.Timestamp(as_of).timestamp()) - days * 86400) % ((step or days) * 86400)
    return f"{seconds} seconds"


def anchored_counts(stream: DataFrame, key: str, as_of: str, days: int, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """Tumbling counts of `days` ending at as-of (ST3).

    Spark windows include their start; shifting time back by one microsecond turns [a, b) into (a, b].
    """
    shifted = stream.withColumn("_t", F.col(ts) - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("_t", late)
    w = F.window("_t", f"{days} days", startTime=window_offset(as_of, days))
    out = shifted.groupBy(w.alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def daily_panes(stream: DataFrame, key: str, as_of: str, ts: str = "ts", publisher: str = "publisher_id", late: str = "1 day") -> DataFrame:
    """Closed one-day panes, a row per key, publisher and day with its records (ST3, ST4).

    Append mode: a pane comes out when the watermark has passed it and then leaves the state, which holds the open
    days only. Panes end at the time of day of `as_of`.
    """
    shifted = stream.withColumn("_t", F.col(ts) - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("_t", late)
    out = shifted.groupBy(F.window("_t", "1 day", startTime=window_offset(as_of, 1)).alias("w"), key, publisher).agg(F.count("*").alias("n"))
    return out.select(key, publisher, F.col("w.end").alias("end"), "n")


def merge_panes(panes: DataFrame, key: str, as_of: str, days: int, step: int, publisher: str = "publisher_id") -> DataFrame:
    """Windows of `days` every `step` days, ending at `as_of` and its multiples, from written panes (ST4, ST3 for days = step).

    A pane belongs to the windows that end between its own end and `days - 1` days later; records add up and the
    distinct publishers are exact, as panes keep them apart.
    """
    anchor = int(pd.Timestamp(as_of).timestamp())
    end = F.unix_timestamp("end")
    first = F.ceil((end - anchor) / F.lit(step * 86400)).cast("long")
    last = F.floor((end + (days - 1) * 86400 - anchor) / F.lit(step * 86400)).cast("long")
    rows = panes.select(key, publisher, "n", F.explode(F.when(first <= last, F.sequence(first, last))).alias("k"))
    parts = rows.groupBy(key, "k", publisher).agg(F.sum("n").alias("n"))
    out = parts.groupBy(key, "k").agg(F.sum("n").alias("evidence_count"), F.count("*").alias("source_count"))
    return out.select(key, F.timestamp_seconds(F.col("k") * (step * 86400) + anchor).alias("as_of"), "evidence_count", "source_count")


def late_or_future(ts: Column, as_of: str, lookback: int = REPLAY_DAYS, tolerance: int = 1) -> Column:
    """Reject code of records outside (as_of - lookback, as_of + tolerance], null inside (ST7)."""
    return (F.when(ts.isNull(), "invalid-date").when(ts > D.days_before(as_of, -tolerance), "future-dated")
            .when(ts <= D.days_before(as_of, lookback), "outside-window"))


def split_by_time(stream: DataFrame, as_of: str, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Accepted records and coded rejects of a stream (ST7)."""
    coded = stream.withColumn("reason", late_or_future(F.col(ts), as_of))
    return coded.filter("reason is null").drop("reason"), coded.filter("reason is not null")


FADING, DORMANT = 30 * 86400000, 90 * 86400000


def quiet(last: int, stage: str, until: int) -> Iterator[tuple[int, str, str]]:
    """Changes (at, before, after) that come of silence from the last record until a time."""
    if stage in ("active", "reactivated") and last + FADING <= until:
        yield last + FADING, stage, "fading"
        stage = "fading"
    if stage == "fading" and last + DORMANT <= until:
        yield last + DORMANT, "fading", "dormant"


def walk(last: int, stage: str, total: int, days: list[tuple[int, int, int]]) -> tuple[int, str, int, list[tuple]]:
    """The activity machine of ST5 and ST6 over days of records (first, last, n) in the order of time.

    A key is active from its first record, fading after 30 days without one, dormant after 90, and reactivated by the
    next record until it fades again. Silence between two records of one batch counts as silence between batches
    does, so the changes don't depend on how records are cut into batches.
    """
    out = []
    for first, newest, n in days:
        if not stage:
            out.append((first, "", "active", total + n))
            stage = "active"
        elif first > last:
            for at, before, stage in quiet(last, stage, first):  # noqa: B020
                out.append((at, before, stage, total))
            if stage in ("fading", "dormant"):
                out.append((first, stage, "reactivated", total + n))
                stage = "reactivated"
        total, last = total + n, max(last, newest)
    return last, stage, total, out


def due(last: int, stage: str) -> int | None:
    """When a key that stays silent changes next; a dormant one doesn't."""
    return None if stage in ("", "dormant") else last + (DORMANT if stage == "fading" else FADING)


def first_due(states: dict) -> int | None:
    return min((d for last, stage, _ in states.values() if (d := due(last, stage)) is not None), default=None)


def day_rows(parts: Iterable[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(first, last, n) of each day from the (day, first, last, n) that the tasks of a batch brought for a key."""
    days: dict[int, tuple[int, int, int]] = {}
    for day, first, newest, n in parts:
        f, l, m = days.get(day, (first, newest, 0))
        days[day] = min(f, first), max(l, newest), m + n
    return [days[d] for d in sorted(days)]


def _frame(key, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({"key": [key[0]] * len(rows), "before": [r[1] for r in rows], "after": [r[2] for r in rows],
                         "at": [pd.Timestamp(r[0], unit="ms") for r in rows], "records": [r[3] for r in rows]})


class LifecycleProcessor(StatefulProcessor):
    """Keyed state (last stamp, stage, count) with event-time timers: a quiet key changes without a new record (ST5).

    A group is a bucket of keys. Every call to the state store takes a round trip from Python, so a bucket reads and
    writes the states of its keys in one call each and has one timer, for the key that is due first.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = handle.getListState("states", "key string, last long, stage string, n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        states = self._read()
        before = first_due(states)
        parts = defaultdict(list)
        for r in rows:
            parts[r["key"]].append((r["day"], r["first"], r["newest"], r["n"]))
        changes = []
        for k, days in parts.items():
            last, stage, total, out = walk(*states.get(k, (0, "", 0)), day_rows(days))
            states[k] = (last, stage, total)
            changes += [(k, *c) for c in out]
        after = first_due(states)
        if after != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)
        self._write(states)
        return map(_row, changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """All keys of the bucket that are due by the watermark change; Spark deletes the timer that expired."""
        states, changes = self._read(), []
        for k, (last, stage, total) in states.items():
            for at, before, after in quiet(last, stage, timerValues.getCurrentWatermarkInMs()):
                changes.append((k, at, before, after, total))
                states[k] = (last, after, total)
        after = first_due(states)
        if after is not None:
            self.handle.registerTimer(after)
        self._write(states)
        return map(_row, changes)

    def _read(self) -> dict[str | None, tuple[int, str, int]]:
        return {k: (last, stage, n) for k, last, stage, n in self.states.get()}

    def _write(self, states: dict) -> None:
        self.states.put([(k, *s) for k, s in states.items()])

    def close(self) -> None:
        pass


def _row(change: tuple) -> Row:
    key, at, before, after, total = change
    stamp = datetime.fromtimestamp(at // 1000, timezone.utc).replace(microsecond=at % 1000 * 1000)
    return Row(key=key, before=before, after=after, at=stamp, records=total)


LIFECYCLE_SCHEMA = "key string, before string, after string, at timestamp, records long"


def combined(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """First and last stamp and count per key and day in each batch of rows, before anything is shuffled.

    A key with a third of all records sends a few rows per task and day to its state and not its records.
    """
    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.groupby(["key", "day"], as_index=False, dropna=False).agg(ts=("ts", "max"), first=("first", "min"), newest=("newest", "max"), n=("n", "sum"))
    at = F.unix_millis(ts)
    return stream.select(F.col(key).alias("key"), F.floor(at / 86400000).cast("long").alias("day"), F.col(ts).alias("ts"), at.alias("first"), at.alias("newest"),
                         F.lit(1).cast("long").alias("n")).mapInPandas(fold, "key string, day long, ts timestamp, first long, newest long, n long")


def timer_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams with timers: their state store is no setting of other streams."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


def lifecycle_changes(stream: DataFrame, key: str, ts: str = "ts", late: str = "1 day", buckets: int = 1024) -> DataFrame:
    """State changes of every direction, driven by records and event-time timers (ST5); run it in a timer_session.

    Keys are dealt into `buckets`, which stay the same as long as a checkpoint is used.
    """
    keyed = combined(stream, key, ts).withWatermark("ts", late).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    return keyed.groupBy("bucket").transformWithState(
        statefulProcessor=LifecycleProcessor(), outputStructType=LIFECYCLE_SCHEMA, outputMode="append", timeMode="eventTime")


def _activity(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, stage, total = state.get if state.exists else (0, "", 0)
    if state.hasTimedOut:
        out = [(at, before, after, total) for at, before, after in quiet(last, stage, state.getCurrentWatermarkMs())]
        stage = out[-1][2] if out else stage
    else:
        parts = (r for f in frames for r in zip(*(f[c].tolist() for c in ("day", "first", "newest", "n"))))
        last, stage, total, out = walk(last, stage, total, day_rows(parts))
    state.update((last, stage, total))
    if stage != "dormant":
        state.setTimeoutTimestamp(max(due(last, stage), state.getCurrentWatermarkMs() + 1))
    if out:
        yield _frame(key, out)


def activity_changes(stream: DataFrame, key: str, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """The same machine for candidates (ST6) on grouped state, which needs no state store of its own."""
    keyed = combined(stream, key, ts).withWatermark("ts", late)
    return keyed.groupBy("key").applyInPandasWithState(
        _activity, LIFECYCLE_SCHEMA, "last long, stage string, n long", "append", GroupStateTimeout.EventTimeTimeout)
