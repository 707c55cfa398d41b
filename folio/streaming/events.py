"""Structured Streaming forms of the incremental semantics: dedupe, windows, rate limits, seen ids."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """events as a stream; event time needs a TIMESTAMP, so ts is cast."""
    r = spark.readStream.schema(EVENTS)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def reject_future(events: DataFrame, as_of, days: int = 2) -> DataFrame:
    """Before any watermark, which such rows would push ahead."""
    return events.where(F.col("ts") <= F.lit(as_of).cast("timestamp") + F.make_dt_interval(F.lit(days)))


def deduplicated(events: DataFrame, key: str = "event_id", delay: str = "48 hours") -> DataFrame:
    """A key counts once within the look-back; state older than the watermark goes."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def tumbling_weeks(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Weeks from Monday (the epoch was a Thursday)."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", "7 days", startTime="4 days"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sliding(events: DataFrame, size: str = "1 hour", step: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", delay).groupBy(F.window("ts", size, step), "event_type").agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))


class _Limiter(StatefulProcessor):
    """The accepted times within the window of each key of a shard, in a map; keys that have fallen silent are dropped as the watermark passes.

    A null key is a key of its own. Of the map only the keys of a micro-batch are read and written.
    """

    def __init__(self, key: str, most: int, micros: int):
        self.key, self.most, self.micros = key, most, micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getMapState("times", "known boolean, id long", "at array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["ts", "event_id"], ignore_index=True)
        keys = list(zip(d["known"].tolist(), d["id"].tolist(), strict=True))
        kept: dict[tuple, list[int]] = {}
        stored, ok = set(), []
        for k, t in zip(keys, d["ts"].astype("datetime64[us]").astype("int64").tolist(), strict=True):
            if k not in kept:
                before = self.times.getValue(k) if self.times.containsKey(k) else None
                kept[k] = list(before[0]) if before else []
                stored |= {k} if before else set()
            times = [x for x in kept[k] if x > t - self.micros]
            ok.append(len(times) < self.most)
            kept[k] = times + [t] * ok[-1]
        for k, times in kept.items():
            if times:
                self.times.updateValue(k, (times,))
            elif k in stored:
                self.times.removeKey(k)
        yield pd.DataFrame({"event_id": d["event_id"], self.key: d["id"].astype("Int64").where(d["known"]), "accepted": ok})
        ends = [times[-1] for times in kept.values() if times]
        if ends and not list(self.handle.listTimers()):
            self._wake(min(ends), timerValues)

    def _wake(self, last: int, timerValues) -> None:
        self.handle.registerTimer(max((last + self.micros) // 1000, timerValues.getCurrentWatermarkInMs()) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, left = timerValues.getCurrentWatermarkInMs() * 1000, []
        for k, (times,) in list(self.times.iterator()):
            if times[-1] + self.micros < now:
                self.times.removeKey(k)
            else:
                left.append(times[-1])
        if left:
            self._wake(min(left), timerValues)
        yield pd.DataFrame()


def _with_state(events: DataFrame) -> DataFrame:
    """Processors with several states and timers need the state store on disk."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return events


def rate_limited(events: DataFrame, key: str = "user_id", most: int = 10, seconds: int = 60, delay: str = "1 hour", shards: int = 256) -> DataFrame:
    """Adds accepted: true if fewer than `most` events of the key were accepted in the `seconds` before; refused ones do not count.

    State is the accepted times of the window, `most` at most a key, in a map a shard of keys, so small keys cost
    an entry each and not a group; an entry goes when the watermark has passed the last of
    them by `seconds`, so keys that fall silent leave nothing behind. Events of one micro-batch are taken in
    the order of time; one that comes later but is older is judged by what was accepted until it came.
    """
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard")
    d = events.withWatermark("ts", delay).select("event_id", "ts", F.col(key).isNotNull().alias("known"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), shard)
    return _with_state(d).groupBy("shard").transformWithStateInPandas(_Limiter(key, most, seconds * 1_000_000), f"event_id long, {key} long, accepted boolean", "Append", "EventTime")


class _Memory(StatefulProcessor):
    """When each key of a shard was seen (or cached) last, in a map; entries older than the time to live are dropped as the watermark passes."""

    def __init__(self, key: str, micros: int, refresh: bool):
        self.key, self.micros, self.refresh = key, micros, refresh

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "id long", "at long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for k, t in zip(initialState[self.key].tolist(), initialState["at"].tolist(), strict=True):
            self.seen.updateValue((int(k),), (int(t),))
        self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs(), (int(initialState["at"].min()) + self.micros) // 1000) + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["ts", "event_id"], ignore_index=True)
        known: dict[int, int | None] = {}
        new = []
        for k, t in zip(d[self.key].tolist(), d["ts"].astype("datetime64[us]").astype("int64").tolist(), strict=True):
            if k not in known:
                known[k] = self.seen.getValue((k,))[0] if self.seen.containsKey((k,)) else None
            before = known[k]
            new.append(before is None or t - before > self.micros)
            if new[-1] or (self.refresh and t > before):
                known[k] = t
        for k, t in known.items():
            self.seen.updateValue((k,), (t,))
        yield self._out(d, new)
        now = timerValues.getCurrentWatermarkInMs()
        if not list(self.handle.listTimers()):
            self.handle.registerTimer(max(now, min(known.values()) // 1000) + self.micros // 1000 + 1)

    def _out(self, d: pd.DataFrame, new: list[bool]) -> pd.DataFrame:
        return pd.DataFrame({"event_id": d["event_id"], self.key: d[self.key], "at": d["ts"].astype("datetime64[us]").astype("int64"), "is_new": new})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        entries = [(k[0], t[0]) for k, t in self.seen.iterator()]
        for k, t in entries:
            if t + self.micros < now * 1000:
                self.seen.removeKey((k,))
        left = [t for _, t in entries if t + self.micros >= now * 1000]
        if left:
            self.handle.registerTimer(max(now, (min(left) + self.micros) // 1000) + 1)
        yield pd.DataFrame()


def remembered(events: DataFrame, key: str = "user_id", hours: float = 48, refresh: bool = True, delay: str = "1 hour", initial: DataFrame | None = None, shards: int = 64) -> DataFrame:
    """(event_id, key, at, is_new): whether the key was unknown, or known for longer than `hours`, when the event came; at is its time in microseconds.

    With `refresh` each event renews its key (ids seen within a look-back); without, an entry lives `hours` from
    when it was made, however often it is hit (a cache). State is a map a shard of keys, so small
    keys cost an entry each and not a group; entries go as the watermark passes them. `initial` (key,
    at) is the memory of an earlier run, see `memory_of`; without it all keys are unknown. Rows without a
    key are left out.
    """
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard")
    d = _with_state(events.where(F.col(key).isNotNull()).withWatermark("ts", delay)).select("event_id", "ts", F.col(key).cast("long").alias(key), shard)
    state = None if initial is None else initial.select(F.col(key).cast("long").alias(key), "at", shard).groupBy("shard")
    out = f"event_id long, {key} long, at long, is_new boolean"
    return d.groupBy("shard").transformWithStateInPandas(_Memory(key, int(hours * 3_600_000_000), refresh), out, "Append", "EventTime", initialState=state)


def memory_of(told: DataFrame, key: str = "user_id", refresh: bool = True, before: DataFrame | None = None) -> DataFrame:
    """(key, at): what a run of `remembered` leaves for the next one, from its output and the memory it began with."""
    entries = (told if refresh else told.where("is_new")).select(key, "at")
    entries = entries if before is None else entries.unionByName(before.select(key, "at"))
    return entries.groupBy(key).agg(F.max("at").alias("at"))


def new_ids(events: DataFrame, key: str = "user_id", keep: str | None = None) -> DataFrame:
    """The first event of each key ever seen; with `keep`, a key unseen for so long counts as new again and its state goes.

    Without `keep` the state is the snapshot of all keys itself, a key each; use the batch form
    (`change.detect_changes` against the stored snapshot) where that outgrows the state store.
    """
    if keep is None:
        return events.dropDuplicates([key])
    return events.withWatermark("ts", keep).dropDuplicatesWithinWatermark([key])


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drives a bounded stream to its end into Parquet and reads that back."""
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_updates(df: DataFrame, path: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Drives a bounded stream in update mode; the last state of each key. Each micro-batch replaces its own part, so a repeated one does no harm."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    parts = df.sparkSession.read.schema(f"{kinds}, batch long").option("basePath", path).parquet(f"{path}/batch=*")
    rest = [f.name for f in df.schema if f.name not in keys]
    return parts.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_s")).select(*keys, "_s.*")


def run_to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Drives a bounded stream to its end into a memory table; for small results."""
    w = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    q = (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
