"""Streaming queries of the catalog.

Each writes its input (bars derived by Spark from ``events``) into a fresh
folder under the shared checkpoint root, streams it with
``trigger(availableNow=True)`` into a parquet sink, and returns the sink
read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.parse import wire_value
from barsmith.operators import bars as B
from barsmith.operators.ema import indicators
from barsmith.operators.sma import sma_join, sma_windows
from barsmith.plans.enriched import served_columns
from barsmith.schema import BAR_SCHEMA, WIRE_FIELDS
from barsmith.session import scratch_path
from barsmith.sources import tables
from barsmith.sources.files import read_store
from barsmith.streaming.live import live_indicators, save_warm_state, warm_state
from barsmith.streaming.panes import sma_panes
from barsmith.streaming.sinks import fan_out, parquet_batch_sink, run, start
from barsmith.streaming.sources import bar_file_stream, heartbeat, wall_time, wire_file_stream

# --- fixed query parameters (same scale as the batch catalog) ----------------
WINDOW = "20 hours"
SLIDE = "1 hour"
WATERMARK = "2 seconds"
DISORDER = "40 days"          # the live input is dealt over files without regard to time
FILES = 5
PRICE_DECIMALS = 2
WARM_CUTOFF = "2024-01-20 00:00:00"
# ----------------------------------------------------------------------------

BAR_COLS = ["symbol", "datetime", "open", "high", "low", "close", "volume"]


def _write_bars(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.select(*BAR_COLS).write.mode("overwrite").parquet(path)
    return path


def _sink(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/_checkpoint"


def _finish(spark: SparkSession, stream: DataFrame, name: str,
            partition_by=("symbol",)) -> DataFrame:
    out, ckpt = _sink(spark, name)
    run(start(stream, ckpt, out, partition_by=partition_by,
              query_name=name.replace("-", "_")))
    return read_store(spark, out)


def q_stream_sma_windows(spark, sf):
    src = _write_bars(spark, tables.bars_1h(spark, sf), "bars")
    s = bar_file_stream(spark, src, BAR_SCHEMA).withWatermark("datetime", WATERMARK)
    agg = sma_windows(s, WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS)
    res = _finish(spark, agg, "stream-sma-windows")
    return res.select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "sma_20")


def q_stream_sma(spark, sf):
    """The reference's stream job on bars: watermark once, 20-hour sliding
    means, joined back on the window end; append output."""
    src = _write_bars(spark, tables.bars_1h(spark, sf), "bars")
    s = bar_file_stream(spark, src, BAR_SCHEMA).withWatermark("datetime", WATERMARK)
    j = sma_join(s, WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS)
    res = _finish(spark, j.select("symbol", "datetime", "close", "sma_20"), "stream-sma")
    return wall_time(res).select("symbol", "datetime", "close", "sma_20")


def _raw_bars(spark, sf):
    """Stream ``events`` itself, resampled to hourly bars with a tumbling event-time window; a bar is final once its hour has closed."""
    from barsmith.operators.bars import resample_stream
    ev = tables.table(spark, sf, "events")
    raw = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet")
           .parquet(sf.rstrip("/")))
    ticks = raw.where(F.col("event_type").isNotNull() & F.col("ts").isNotNull()
                      & F.col("value").isNotNull()).select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("datetime"),
        F.col("event_id").alias("tick_id"), F.col("value").alias("price"))
    return resample_stream(ticks.withWatermark("datetime", WATERMARK), "1 hour")


def q_stream_sma_raw(spark, sf):
    """From raw ticks: hourly bars, then the SMA join -- two chained stateful
    steps under one watermark."""
    j = sma_join(_raw_bars(spark, sf), WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS, window_col="event_time")
    res = _finish(spark, j.select("symbol", "datetime", "close", "sma_20"), "stream-sma-raw")
    return wall_time(res).select("symbol", "datetime", "close", "sma_20")


def q_stream_sma_panes(spark, sf):
    """From raw ticks: hourly bars, then their means out of pane sums."""
    j = sma_panes(_raw_bars(spark, sf), WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS)
    res = _finish(spark, j.select("symbol", "datetime", "close", "sma_20"), "stream-sma-panes")
    return wall_time(res).select("symbol", "datetime", "close", "sma_20")


def q_stream_sma_late(spark, sf):
    """After the first run, a file of stale bars (older than the watermark,
    with absurd prices) arrives and the query restarts from its checkpoint:
    the late rows are dropped, so no mean changes."""
    bars = tables.bars_1h(spark, sf)
    base = scratch_path(spark, "late-src")
    bars.select(*BAR_COLS).write.mode("overwrite").parquet(f"{base}/part=1")
    out, ckpt = _sink(spark, "stream-sma-late")

    def query():
        s = bar_file_stream(spark, f"{base}/*", BAR_SCHEMA).withWatermark("datetime", WATERMARK)
        j = sma_join(s, WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS)
        return start(j.select("symbol", "datetime", "close", "sma_20"), ckpt, out)

    run(query())
    stale = (bars.withColumn("close", F.lit(1.0e6)).withColumn("high", F.lit(1.0e6))
                 .where(F.col("datetime") < F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")))
    stale.select(*BAR_COLS).write.mode("overwrite").parquet(f"{base}/part=2")
    run(query())
    return wall_time(read_store(spark, out)).select("symbol", "datetime", "close", "sma_20")


def q_stream_fan_out(spark, sf):
    """The SMA stream written to two sinks by one query: one source read and
    one state feed both (each micro-batch persisted once).  Returns the
    first sink."""
    src = _write_bars(spark, tables.bars_1h(spark, sf), "bars")
    s = bar_file_stream(spark, src, BAR_SCHEMA).withWatermark("datetime", WATERMARK)
    j = sma_join(s, WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS).select(
        "symbol", "datetime", "close", "sma_20")
    base = scratch_path(spark, "stream-fan-out")
    run(fan_out(j, [parquet_batch_sink(f"{base}/store"), parquet_batch_sink(f"{base}/copy")],
                f"{base}/_checkpoint"))
    store = read_store(spark, f"{base}/store").drop("_epoch")
    return wall_time(store).select("symbol", "datetime", "close", "sma_20")


def q_stream_enriched(spark, sf):
    """Whole stream path: bars with batch indicators go out as JSON wire
    messages (all fields text); the stream parses them, adds the SMA and
    appends the 15 served columns."""
    ind = indicators(tables.bars_1h(spark, sf))
    wire = ind.select("symbol", wire_value(ind).alias("value"))
    path = scratch_path(spark, "wire")
    wire.write.mode("overwrite").json(path)
    s = wire_file_stream(spark, path).withWatermark("datetime", WATERMARK)
    j = served_columns(sma_join(s, WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS))
    res = wall_time(_finish(spark, j, "stream-enriched"))
    r6 = {c: F.round(c, 6) for c in ("ema_12", "ema_16", "ema_30", "ema_200", "signal", "macd")}
    return res.select("symbol", *served_columns(res).columns[1:]).withColumns(r6)


def _live_out(res: DataFrame) -> DataFrame:
    r6 = {c: F.round(c, 6) for c in ("ema_12", "ema_16", "ema_30", "ema_200", "macd", "signal")}
    return wall_time(res).select("symbol", "datetime", "ema_12", "ema_16", "ema_30", "ema_200",
                                 "macd", "signal", "support", "resistance").withColumns(r6)


def _live(spark, bars, name: str, init=None, to_wire: bool = False) -> DataFrame:
    """Live indicators over unsorted files with repeated bars, a file a micro-batch.

    The watermark tolerates the disorder of the whole input; a heartbeat after
    its end releases the bars that wait.
    """
    base = scratch_path(spark, name)
    first = F.pmod(F.xxhash64("symbol", "datetime"), F.lit(FILES))
    again = F.pmod(F.xxhash64("datetime", "symbol"), F.lit(3 * FILES))
    copies = bars.select(*BAR_COLS, first.alias("part")).unionByName(
        bars.where(again < FILES).select(*BAR_COLS, again.alias("part")))
    copies.repartition(FILES, "part").drop("part").write.parquet(f"{base}/part=0")
    out, ckpt = _sink(spark, name)

    def query():
        s = bar_file_stream(spark, f"{base}/*", BAR_SCHEMA, max_files_per_trigger=1)
        live = live_indicators(s.withWatermark("datetime", DISORDER), init)
        if to_wire:
            live = live.select("symbol", wire_value(live, WIRE_FIELDS).alias("value"))
        return start(live, ckpt, out, fmt="json" if to_wire else "parquet", partition_by=() if to_wire else ("symbol",))

    run(query())
    heartbeat(spark, f"{base}/part=1", bars, DISORDER)
    run(query())
    return out


def q_stream_indicators(spark, sf):
    """Keyed live recursion over the whole bar stream (no warm state)."""
    return _live_out(read_store(spark, _live(spark, tables.bars_1h(spark, sf), "stream-indicators")))


def q_stream_warm_start(spark, sf):
    """History before the cutoff in batch, handed over as state; the rest live."""
    bars = tables.bars_1h(spark, sf)
    cut = F.lit(WARM_CUTOFF).cast("timestamp_ntz")
    warm = indicators(bars.where(F.col("datetime") < cut), levels=False)
    state = save_warm_state(warm_state(warm), scratch_path(spark, "warm-state"))
    return _live_out(read_store(spark, _live(spark, bars.where(F.col("datetime") >= cut), "stream-warm", state)))


def q_stream_live_enriched(spark, sf):
    """Both stages of the live flow: bars -> live indicators -> JSON wire
    messages, and a second stream over these -> SMA join -> 15 served columns."""
    wire = _live(spark, tables.bars_1h(spark, sf), "stream-wire", to_wire=True)
    s = wire_file_stream(spark, wire).withWatermark("datetime", WATERMARK)
    j = served_columns(sma_join(s, WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS))
    res = wall_time(_finish(spark, j, "stream-live-enriched"))
    r6 = {c: F.round(c, 6) for c in ("ema_12", "ema_16", "ema_30", "ema_200", "signal", "macd")}
    return res.select("symbol", *served_columns(res).columns[1:]).withColumns(r6)


def q_stream_dedup(spark, sf):
    """A re-fetch that repeats the newest bars arrives after a restart from
    the checkpoint; the keyed dedup state (bounded by the watermark) drops it."""
    bars = tables.bars_1h(spark, sf)
    base = scratch_path(spark, "dedup-src")
    bars.select(*BAR_COLS).write.mode("overwrite").parquet(f"{base}/part=1")
    out, ckpt = _sink(spark, "stream-dedup")

    def query():
        s = bar_file_stream(spark, f"{base}/*", BAR_SCHEMA).withWatermark("datetime", WATERMARK)
        d = B.dedup_stream(s)
        return start(d, ckpt, out)

    run(query())
    B.latest_n_per_symbol(bars, 5).select(*BAR_COLS).write.mode("overwrite").parquet(f"{base}/part=2")
    run(query())                       # restart: same checkpoint, new file only
    return wall_time(read_store(spark, out)).select(*BAR_COLS)


def q_stream_dedup_best(spark, sf):
    """Copies with differing content, an earlier fetch after the fuller one and
    the other way round, over several files and a restart: the stream keeps the
    copies that the batch keeps, up to the watermark."""
    bars = tables.bars_1h(spark, sf).select(*BAR_COLS)
    less = bars.withColumns({"volume": F.col("volume") - 1, "close": F.col("close") + 1})
    early = F.pmod(F.xxhash64("symbol", "datetime"), F.lit(2)) == 0
    base = scratch_path(spark, "best-src")
    bars.where(early).unionByName(less.where(~early)).write.parquet(f"{base}/part=1")
    out, ckpt = _sink(spark, "stream-dedup-best")

    def query():
        # the second fetch comes as late as the whole first one
        s = bar_file_stream(spark, f"{base}/*", BAR_SCHEMA).withWatermark("datetime", DISORDER)
        return start(B.best_of_stream(s), ckpt, out)

    run(query())
    bars.where(~early).unionByName(less.where(early)).write.parquet(f"{base}/part=2")
    run(query())
    heartbeat(spark, f"{base}/part=3", bars, DISORDER)
    run(query())                       # the watermark passes all bars
    return wall_time(read_store(spark, out)).where("symbol is not null").select(*BAR_COLS)


def catalog():
    return {name[2:]: fn for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}
