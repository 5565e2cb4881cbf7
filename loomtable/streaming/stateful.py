"""Stateful operators over rows that still arrive: exact first-wins deduplication, and a state machine for each request.

State is kept by key in RocksDB, so a batch costs what it brings, not what was seen before it; a stream that is started again from its
checkpoint goes on where it ended.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from loomtable.operators import clean
from loomtable.plans.schema import Schema

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_rocksdb(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB, which the operators here need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class First(StatefulProcessor):
    """Lets the first row of a key pass, by an order within a batch, and none after it."""

    def __init__(self, order: str) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if self.seen.exists():
            return
        first = min(rows, key=lambda r: (r[self.order] is None, r[self.order]))
        self.seen.update((True,))
        yield first

    def close(self) -> None:
        pass


def first_wins(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Each key's first row (X04, A06, W01) of a stream, for append mode: of the batch that brings the key, the least by ``order``.

    A key is remembered for good, so a repeat never passes, however late; rows with null keys are of one key. What is kept
    of a key is the key itself, which should be a digest where values are long.
    """
    with_rocksdb(rows.sparkSession)
    return rows.groupBy(*keys).transformWithState(First(order), outputStructType=rows.schema, outputMode="Append", timeMode="None")


def distinct_listings(listings: DataFrame, schema: Schema, seq: str = "seq") -> DataFrame:
    """The listings of a stream that are valid and repeat no earlier one: what ``clean.with_reason`` keeps, but for images, as they arrive."""
    rows = clean.keyed(listings, schema).where("__first is null").drop("__first")
    return first_wins(rows, ["content_hash"], seq)


REQUEST = "request_id {kind}, ttft_ms double, total_latency_ms double, completion_tokens long, token_latencies_ms array<double>, tokens_per_sec double"


class Requests(StatefulProcessor):
    """A request: waiting, then answering, then finished by its usage or by silence. Times are microseconds."""

    def __init__(self, silence_ms: int) -> None:
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("request", "begun long, first long, last long, chunks long, content long, gaps array<double>")

    def _finished(self, key: Any, usage: int | None, state: tuple) -> Row:
        begun, first, last, chunks, _, gaps = state
        first = last if first is None else first
        tokens = chunks if usage is None else usage
        return Row(
            request_id=key[0], ttft_ms=(first - begun) / 1000, total_latency_ms=(last - begun) / 1000, completion_tokens=tokens, token_latencies_ms=list(gaps or []),
            tokens_per_sec=tokens / ((last - first) / 1e6) if last > first else 0.0,
        )

    def handleInputRows(self, key: Any, rows: Iterable[Row], timerValues: Any) -> Iterator[Row]:
        old = self.state.get()
        begun, first, last, chunks, content, gaps = old or (None, None, None, 0, None, [])
        gaps, usage = list(gaps or []), None
        for at, since, has_content, tokens in sorted(((r["__us"], r["__begun"], r["has_content"], r["usage_tokens"]) for r in rows), key=lambda r: r[0]):
            begun, last = since if begun is None else min(begun, since), at if last is None else max(last, at)
            if has_content:
                first, chunks = at if first is None else min(first, at), chunks + 1
                if content is not None:
                    gaps.append((at - content) / 1000)
                content = at
            usage = tokens if usage is None else usage
        now = (begun, first, last, chunks, content, gaps)
        if usage is None:
            self.state.update(now)
            if old is None:
                self.handle.registerTimer(last // 1000 + self.silence_ms)
            return
        if old is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.state.clear()
        yield self._finished(key, usage, now)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        """A request has one timer, for the silence after the chunks that it began with; one that has gone on since then is waited for again."""
        state = self.state.get()
        if state is None:
            return
        due = state[2] // 1000 + self.silence_ms
        if due > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
            return
        self.state.clear()
        yield self._finished(key, None, state)

    def close(self) -> None:
        pass


def requests(chunks: DataFrame, silence: str = "1 minute", late: str = "10 seconds") -> DataFrame:
    """A row for each finished request (X01, S19, A11) of a stream of chunks: request_id, ts and start (timestamps), has_content,
    usage_tokens. For append mode.

    The chunk that reports usage ends its request at once; a request that has been silent for so long ends with what it has. The state of a request
    grows with its answer alone and goes when it ends. Chunks later than ``late`` behind the newest are left out; one that comes after its request's end
    begins another.
    """
    with_rocksdb(chunks.sparkSession)
    silence_ms = int(chunks.sparkSession.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + INTERVAL {silence}) DIV 1000").first()[0])
    rows = chunks.withWatermark("ts", late).select(
        "request_id", "ts", "has_content", F.col("usage_tokens").cast("long").alias("usage_tokens"), F.unix_micros("ts").alias("__us"), F.unix_micros("start").alias("__begun")
    )
    kind = chunks.schema["request_id"].dataType.simpleString()
    return rows.groupBy("request_id").transformWithState(Requests(silence_ms), outputStructType=REQUEST.format(kind=kind), outputMode="Append", timeMode="EventTime")


def run_arrived(stream: DataFrame, path: str, checkpoint: str, settle: bool = True) -> None:
    """Runs a stream over all that has arrived and appends its rows to ``path``; started again, it goes on from its checkpoint.

    The time that the rows move on ends silent keys in a batch without rows, at once; without ``settle`` the next run's batch ends them, which saves a
    round over all state where more is known to follow.
    """
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    if not settle:
        conf.set(name, "false")
    try:
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(name, before)
    query.awaitTermination()
