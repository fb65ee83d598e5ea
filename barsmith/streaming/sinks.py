"""Starting, fanning out and finishing streaming queries."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def _trigger(w, trigger):
    if trigger == "availableNow":
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    if isinstance(trigger, str):
        return w.trigger(processingTime=trigger)
    return w


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FILE_FORMATS = ("parquet", "json", "csv", "orc", "text")


@contextmanager
def state_settings(spark: SparkSession, state_partitions: int | None):
    """Settings that a query copies when it starts: RocksDB for its state, and
    the number of its state partitions, which is fixed for the life of the
    checkpoint.  Without a number it is the session's
    ``spark.barsmith.statePartitions``, else its shuffle partitions."""
    count = state_partitions or spark.conf.get("spark.barsmith.statePartitions", None)
    want = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if count:
        want["spark.sql.shuffle.partitions"] = str(count)
    old = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start(df: DataFrame, checkpoint: str, path: str | None = None, fmt: str = "parquet",
          trigger: str | None = "availableNow", output_mode: str = "append",
          partition_by: tuple[str, ...] = ("symbol",), query_name: str | None = None,
          state_partitions: int | None = None, options: dict[str, str] | None = None) -> StreamingQuery:
    """Start an append query with a mandatory checkpoint.

    ``options`` go to the sink (a connector's address, database, collection);
    only file formats are partitioned.
    """
    if not checkpoint:
        raise ValueError("a streaming query needs a checkpoint folder")
    listen(df.sparkSession)
    with state_settings(df.sparkSession, state_partitions):
        w = df.writeStream.format(fmt).outputMode(output_mode).options(**(options or {}))
        w = w.option("checkpointLocation", checkpoint)
        if path and fmt not in ("memory", "console"):
            w = w.option("path", path)
        if partition_by and fmt in FILE_FORMATS:
            w = w.partitionBy(*partition_by)
        if query_name:
            w = w.queryName(query_name)
        return _trigger(w, trigger).start()


def write_serving_stream(df: DataFrame, path: str, checkpoint: str,
                         trigger: str | None = "availableNow") -> StreamingQuery:
    """Append served bars to a parquet store partitioned by symbol."""
    return start(df, checkpoint, path, "parquet", trigger)


def write_console(df: DataFrame, checkpoint: str, truncate: bool = False,
                  trigger: str | None = None) -> StreamingQuery:
    """Debug sink: print each appended batch."""
    return start(df, checkpoint, fmt="console", trigger=trigger, options={"truncate": str(truncate).lower()})


def fan_out(df: DataFrame, sinks: list[Callable[[DataFrame, int], None]], checkpoint: str,
            trigger: str | None = "availableNow", state_partitions: int | None = None) -> StreamingQuery:
    """One read, one state, several sinks: each micro-batch is persisted once
    and handed to every sink (instead of one query per sink)."""

    def each(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, epoch_id)
        finally:
            batch.unpersist()

    listen(df.sparkSession)
    with state_settings(df.sparkSession, state_partitions):
        w = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        return _trigger(w, trigger).start()


def parquet_batch_sink(path: str, partition_by: tuple[str, ...] = ("symbol",)):
    """A ``fan_out`` sink writing each micro-batch to its own ``_epoch=N``
    folder with overwrite, so a batch replayed after a failure replaces its
    earlier attempt instead of duplicating it."""

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/_epoch={epoch_id}")

    return sink


class Meter:
    """Counts over the micro-batches of a query that was not started here.

    ``recentProgress`` keeps the newest hundred only, so the meter must be read
    again and again while the query runs; it adds each batch once.
    """

    def __init__(self, query: StreamingQuery):
        self.query = query
        self.batches: dict[int, tuple[int, int]] = {}

    def read(self) -> "Meter":
        for p in self.query.recentProgress:
            late = sum(int(op.get("numRowsDroppedByWatermark", 0) or 0) for op in p.get("stateOperators", []))
            key = int(p["batchId"])
            rows, dropped = self.batches.get(key, (0, 0))
            self.batches[key] = (max(rows, int(p.get("numInputRows", 0))), max(dropped, late))
        return self

    @property
    def with_data(self) -> int:
        return sum(rows > 0 for rows, _ in self.batches.values())

    @property
    def dropped(self) -> int:
        return sum(late for _, late in self.batches.values())


class Counts:
    """Running counts of one run: closed batches, and the newest one, which may be reported again."""

    def __init__(self):
        self.closed_data = self.closed_late = 0
        self.batch, self.rows, self.late = -1, 0, 0
        self.ended = threading.Event()

    def add(self, batch: int, rows: int, late: int) -> None:
        if batch != self.batch:
            self.closed_data, self.closed_late = self.with_data, self.dropped
            self.batch, self.rows, self.late = batch, 0, 0
        self.rows, self.late = max(self.rows, rows), max(self.late, late)

    @property
    def with_data(self) -> int:
        return self.closed_data + (self.rows > 0)

    @property
    def dropped(self) -> int:
        return self.closed_late + self.late


class ProgressListener(StreamingQueryListener):
    """Counts of every run of the session's queries, told by Spark batch by batch; nobody has to poll."""

    def __init__(self):
        self.runs: dict[str, Counts] = {}

    def onQueryStarted(self, event) -> None:
        self.runs.setdefault(str(event.runId), Counts())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)
        self.runs.setdefault(str(p.runId), Counts()).add(int(p.batchId), int(p.numInputRows), late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.runs.setdefault(str(event.runId), Counts()).ended.set()


_LISTENERS: dict[str, ProgressListener] = {}
_METERS: dict[str, Meter] = {}


def listen(spark: SparkSession) -> ProgressListener:
    """The session's progress listener; ``start`` and ``fan_out`` add it before their first query."""
    app = spark.sparkContext.applicationId
    if app not in _LISTENERS:
        listener = ProgressListener()
        spark.streams.addListener(listener)
        _LISTENERS.clear()                 # of sessions that have ended
        _LISTENERS[app] = listener
    return _LISTENERS[app]


def meter(query: StreamingQuery, timeout_s: float = 30) -> Counts | Meter:
    """Counts of a query's run up to now; of an ended run, all of them."""
    for listener in _LISTENERS.values():
        counts = listener.runs.get(str(query.runId))
        if counts is not None:
            if not query.isActive:
                counts.ended.wait(timeout_s)   # events come in order, the end last
            return counts
    return _METERS.setdefault(str(query.runId), Meter(query)).read()


def _raise_failure(query: StreamingQuery) -> StreamingQuery:
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def run(query: StreamingQuery, timeout_s: float | None = None, poll_s: float = 0.5) -> StreamingQuery:
    """Wait for a bounded (``availableNow``) query and surface its failure."""
    end = None if timeout_s is None else time.time() + timeout_s
    try:
        while not query.awaitTermination(poll_s) and (end is None or time.time() < end):
            pass
    except StreamingQueryException as e:
        raise RuntimeError(str(e)) from e
    return _raise_failure(query)


def stop_after_batches(query: StreamingQuery, n_batches: int, poll_s: float = 0.5,
                       timeout_s: float | None = None) -> StreamingQuery:
    """Run a live (processing-time) query for ``n_batches`` micro-batches that
    carried data, then stop it gracefully (a bounded run of N samples)."""
    t0 = time.time()
    while query.isActive:
        if meter(query).with_data >= n_batches or (timeout_s is not None and time.time() - t0 > timeout_s):
            break
        time.sleep(poll_s)
    query.stop()
    return _raise_failure(query)


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any active query stops; a failure in any is raised.  Ended
    queries are forgotten, so that the next call waits for the others."""
    try:
        spark.streams.awaitAnyTermination(timeout_s)
    finally:
        spark.streams.resetTerminated()


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that stateful operators dropped as late, over all batches of the run."""
    return meter(query).dropped
