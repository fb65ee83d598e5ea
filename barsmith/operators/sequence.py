"""Order-dependent scans over keyed series, without one task per key.

A window ``partitionBy(symbol).orderBy(datetime)`` puts a whole symbol in one
task; if one symbol holds a third of the data, that task holds a third of the
data.  Here a series is cut by time instead:

1. *Buckets.*  A row's bucket is ``floor(time / width)``, so its place is a
   function of the row alone: nothing is sampled or numbered, and a lost task
   gives the same rows again.  One exchange lays the rows out by (key, bucket);
   ``width`` should hold some thousands of rows of a dense key.
2. *Blocks.*  Inside a bucket rows are numbered in order, and every ``B`` rows
   are a block, so that a bucket of any density works.  Within a block a linear
   recurrence ``y = b*y_prev + (1-b)*x`` (EMA) has the closed form
   ``loc_i = b^i * sum_{j<=i} b^-j (1-b) x_j``, a running window sum; ``B`` is
   chosen so that ``b^-B`` stays far from overflow.  Lags are taken over the
   bucket.  ``frames`` adds sums over a time range before each row: the rows of
   the last stretch of a bucket are copied to the buckets that look back on them.
3. *Tree.*  A block, and any run of blocks, maps the state before it to the
   state after it: rows add up, ``y -> b^n y + L``, and the last ``K`` values of
   the lag columns move on.  Buckets are gathered by ``2^FAN_LOG2`` consecutive ones
   into sorted arrays, those again, up to one array a key; the arrays are folded
   with ``aggregate``, upwards for the maps of whole arrays, downwards for
   the state before every bucket and block.  All of it is built-in functions.
4. *Carry.*  The states are joined back on (key, bucket), which is the layout
   that the rows already have: ``y = loc + b^(i+1) * carry``, ``row index =
   rows before + r``, and lags that reach into earlier buckets come from the carry.

The rows and the summaries are two branches over the same exchange.  It is reused
only if both ask for the same columns, so the row number names all of them
(``_numbered``); give a scan the columns that are wanted, not more.  No look-back
is truncated: results are exact up to rounding.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.functions.timefns import epoch_micros, interval_micros

MAX_BLOCK_LOG2 = 12          # at most 4096 rows per block
FAN_LOG2 = 8                 # 256 children of a node of the tree
_EXP_BUDGET = 500.0          # keep b^-i below e^500 (double max ~ e^709)

#: Width of a bucket if the caller names none.
DEFAULT_BUCKET = "7 days"
#: The tree has as many levels as 400 years (integers: 2^40) of buckets ask for; other times only lengthen its top array.
_SPAN_MICROS = 400 * 366 * 86_400_000_000
_SPAN_INTEGERS = 1 << 40


def ema_decay(span: float) -> float:
    """b = 1 - alpha with alpha = 2 / (span + 1)."""
    alpha = 2.0 / (span + 1.0)
    return 1.0 - alpha


def block_log2_for(decays: list[float]) -> int:
    """Largest block (as log2) for which b^-(B-1) stays within the budget."""
    lam = max([-math.log(b) for b in decays if 0.0 < b < 1.0] or [0.0])
    if lam == 0.0:
        return MAX_BLOCK_LOG2
    return max(0, min(MAX_BLOCK_LOG2, int(math.floor(math.log2(_EXP_BUDGET / lam)))))


@dataclass
class Recurrence:
    """``out = b * out_prev + g * src`` with ``g = 1 - b`` unless given,
    seeded with the first ``src`` (``seeded=False``: started from 0).
    ``decay=1, gain=1, seeded=False`` is a running sum."""
    out: str
    src: str
    decay: float
    seeded: bool = True
    gain: float | None = None

    @property
    def weight(self) -> float:
        return 1.0 - self.decay if self.gain is None else self.gain


def running_sum(out: str, src: str) -> Recurrence:
    return Recurrence(out, src, 1.0, seeded=False, gain=1.0)


@dataclass
class Frame:
    """``out_sum`` and ``out_count`` of ``src`` over the times ``[t - span, t)`` before each row."""
    out: str
    src: str
    span: int


@dataclass
class ScanSpec:
    recurrences: list[Recurrence] = field(default_factory=list)
    lag_cols: list[str] = field(default_factory=list)
    max_lag: int = 0
    index_col: str | None = None       # 0-based position within the key
    frames: list[Frame] = field(default_factory=list)


def positions(df: DataFrame, col: str) -> tuple[Column, int]:
    """(place of a row on the time axis as a long, extent of the axis): micros of dates and timestamps, integers as they are."""
    if isinstance(df.schema[col].dataType, T.IntegralType):
        return F.col(col).cast("long"), _SPAN_INTEGERS
    return epoch_micros(col), _SPAN_MICROS


def _bucket_of(at: Column, width: int) -> Column:
    return ((at - F.pmod(at, F.lit(width))) / F.lit(width)).cast("long")


def _hashable(df: DataFrame) -> list[Column]:
    return [F.map_entries(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema.fields]


def _numbered(df: DataFrame, key: str, order: list[str], spec: ScanSpec, width: int) -> DataFrame:
    """Rows with ``_k``, ``_b`` (bucket), ``_t``, ``_r`` (number in the bucket), their lags and frame sums; laid out by (key, bucket)."""
    at, _ = positions(df, order[0])
    rows = df.where(F.col(key).isNotNull() & F.col(order[0]).isNotNull()).withColumns({"_k": F.col(key), "_t": at})
    reach = max([f.span for f in spec.frames], default=0)
    if reach:
        rows = rows.withColumn("_own", _bucket_of(F.col("_t"), width))
        rows = rows.withColumn("_b", F.explode(F.sequence(F.col("_own"), _bucket_of(F.col("_t") + reach, width))))
        rows = rows.withColumn("_own", F.col("_own") == F.col("_b"))
    else:
        rows = rows.withColumn("_b", _bucket_of(F.col("_t"), width))
    w = Window.partitionBy("_k", "_b").orderBy("_t", *order[1:])
    number = F.row_number().over(w) if not reach else F.count(F.when(F.col("_own"), 1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    cols = {"_r": number.cast("long") - 1}
    for c in spec.lag_cols:
        cols.update({f"_{c}_l{k}": F.lag(c, k).over(w) for k in range(1, spec.max_lag + 1)})
    for f in spec.frames:
        before = Window.partitionBy("_k", "_b").orderBy("_t").rangeBetween(-f.span, -1)
        cols[f"{f.out}_sum"], cols[f"{f.out}_count"] = F.sum(f.src).over(before), F.count(f.src).over(before)
    if spec.lag_cols:
        cols["_end"] = F.lead(F.lit(1)).over(w).isNull()
    rows = rows.withColumns(cols)
    if reach:
        rows = rows.where("_own").drop("_own")
    # never negative; see the module's docstring
    return rows.withColumn("_r", F.when(F.col("_r") < 0, F.xxhash64(*_hashable(df))).otherwise(F.col("_r")))


class _Maps:
    """SQL texts for the maps of runs of rows (structs ``n, l0.., x0.., h0..``) and for states (``n, c0.., h0..``).

    As texts, because lambdas over many columns are slow to build call by call.
    """

    def __init__(self, recs: list[Recurrence], halos: int, keep: int):
        self.recs, self.halos, self.keep = recs, halos, keep
        self.state = "struct<" + ", ".join(["n: bigint", *[f"c{i}: double" for i in range(len(recs))], *[f"h{j}: array<double>" for j in range(halos)]]) + ">"

    def _struct(self, n: str, rec, halo, name: str = "c", more: tuple = ()) -> str:
        fields = [("n", n), *[(f"{name}{i}", rec(i, r)) for i, r in enumerate(self.recs)], *more, *[(f"h{j}", halo(j)) for j in range(self.halos)]]
        return "named_struct(" + ", ".join(f"'{f}', {v}" for f, v in fields) + ")"

    def start(self, first: str | None) -> str:
        """The state before a key's first row (its first inputs seed the averages), or with ``None`` the neutral one."""
        return self._struct("0L", lambda i, r: f"{first}.x{i}" if first and r.seeded else "0D", lambda j: "cast(array() as array<double>)")

    def after(self, s: str, m: str) -> str:
        """The state after a run of rows."""
        def halo(j):
            both = f"concat({s}.h{j}, {m}.h{j})"
            return f"slice({both}, greatest(size({both}) - {self.keep - 1}, 1), {max(self.keep, 1)})"
        kept = lambda i, r: f"{s}.c{i}" if r.decay == 1.0 else f"{s}.c{i} * pow({r.decay!r}D, {m}.n)"
        return self._struct(f"{s}.n + {m}.n", lambda i, r: f"{kept(i, r)} + {m}.l{i}", halo)

    def whole(self, runs: str) -> Column:
        """The map of consecutive runs (structs of a place ``p`` and a map ``m``)."""
        first = tuple((f"x{i}", f"{runs}[0].m.x{i}") for i in range(len(self.recs)))
        end = self._struct("s.n", lambda i, r: f"s.c{i}", lambda j: f"s.h{j}", "l", first)
        return F.expr(f"aggregate({runs}, {self.start(None)}, (s, run) -> {self.after('s', 'run.m')}, s -> {end})")

    def before_each(self, runs: str, start: str) -> Column:
        """The states before every one of consecutive runs."""
        zero = f"named_struct('s', {start}, 'out', cast(array() as array<{self.state}>))"
        step = f"named_struct('s', {self.after('acc.s', 'run.m')}, 'out', concat(acc.out, array(acc.s)))"
        return F.expr(f"aggregate({runs}, {zero}, (acc, run) -> {step}, acc -> acc.out)")


def _summaries(rows: DataFrame, recs: list[Recurrence], spec: ScanSpec, lg: int) -> DataFrame:
    """(_k, pos, runs): the maps of the blocks of every bucket, in order."""
    i = F.col("_r").bitwiseAND(F.lit((1 << lg) - 1))
    aggs = [F.count(F.lit(1)).alias("n")]
    for k, r in enumerate(recs):
        if r.decay == 1.0:
            total = F.sum(F.lit(r.weight) * F.col(r.src))
        else:
            total = F.pow(F.lit(r.decay), F.max(i)) * F.sum(F.pow(F.lit(r.decay), -i) * (F.lit(r.weight) * F.col(r.src)))
        aggs += [total.alias(f"l{k}"), F.max(F.when(i == 0, F.col(r.src))).alias(f"x{k}")]
    K = spec.max_lag
    for j, c in enumerate(spec.lag_cols):
        aggs += [F.max(F.when(F.col("_end"), F.col(c) if k == 0 else F.col(f"_{c}_l{k}"))).alias(f"_h{j}_{k}") for k in range(K)]
        aggs.append(F.max(F.when(F.col("_end"), F.col("_r") + 1)).alias(f"_m{j}"))
    blocks = rows.groupBy("_k", "_b", F.shiftright("_r", lg).alias("_sub")).agg(*aggs)
    halos = []
    for j, _ in enumerate(spec.lag_cols):
        # last K values of the bucket, oldest first; fewer if the bucket is short, none before its last block
        tail = F.array(*[F.col(f"_h{j}_{k}") for k in range(K - 1, -1, -1)]) if K else F.array().cast("array<double>")
        have = F.least(F.coalesce(F.col(f"_m{j}"), F.lit(0)), F.lit(K)).cast("int")
        halos.append(F.slice(tail, F.lit(K) - have + 1, have).cast("array<double>").alias(f"h{j}") if K else tail.alias(f"h{j}"))
    m = F.struct("n", *[f"l{k}" for k in range(len(recs))], *[f"x{k}" for k in range(len(recs))], *halos)
    return blocks.groupBy("_k", F.col("_b").alias("pos")).agg(F.sort_array(F.collect_list(F.struct(F.col("_sub").alias("p"), m.alias("m")))).alias("runs"))


def _carries(summaries: DataFrame, maps: _Maps, levels: int) -> DataFrame:
    """(_ck, _cb, _in, _at): the state before every bucket and before each of its blocks.

    The lowest arrays keep the blocks of their buckets, so the summaries are read
    once.  Joins are outer ones: the filters inferred from inner ones would reach
    the scans of some branches only, and exchanges would not be reused.
    """
    nodes = [summaries.select("_k", "pos", F.expr("runs AS blocks"), maps.whole("runs").alias("m"))]
    for level in range(levels):
        run = F.struct(F.col("pos").alias("p"), "m", *(["blocks"] if level == 0 else []))
        by = ["_k"] if level == levels - 1 else ["_k", F.expr(f"shiftright(pos, {FAN_LOG2})").alias("pos")]
        runs = nodes[-1].groupBy(*by).agg(F.sort_array(F.collect_list(run)).alias("runs"))
        nodes.append(runs.withColumn("m", maps.whole("runs")) if level < levels - 1 else runs)
    states = nodes[-1].selectExpr("_k", "runs", f"{maps.start('runs[0].m')} AS _s")
    for level in range(levels, 0, -1):
        each = states.select(F.col("_k").alias("_ck"), F.explode(F.arrays_zip("runs", maps.before_each("runs", "_s").alias("s"))).alias("e"))
        if level == 1:
            return each.select("_ck", F.expr("e.runs.p AS _cb"), F.expr("e.s AS _in"), maps.before_each("e.runs.blocks", "e.s").alias("_at"))
        down = each.selectExpr("_ck AS _dk", "e.runs.p AS _dp", "e.s AS _s")
        states = nodes[level - 1].join(down, F.expr("_k = _dk AND pos = _dp"), "left").select("_k", "runs", "_s")
    raise ValueError("a tree has a level")


def scan(df: DataFrame, key: str, order: list[str], spec: ScanSpec, bucket: str | int = DEFAULT_BUCKET,
         block_log2: int | None = None) -> DataFrame:
    """Add recurrence outputs, lag columns ``{c}_lag{k}``, frame sums and the row index.

    ``order`` is the time column and what breaks its ties; with the key it makes
    rows unique.  ``bucket`` is an interval, or an integer in the units of an integer
    time column.  Rows without a key or a time are left out.
    """
    recs = [r for r in spec.recurrences if r.decay > 0.0]
    safe = block_log2_for([r.decay for r in recs])
    lg = safe if block_log2 is None else block_log2
    if lg > safe:
        raise ValueError(f"blocks of 2^{lg} rows overflow b^-i for these spans; use at most 2^{safe} (block_log2_for)")
    width = bucket if isinstance(bucket, int) else interval_micros(bucket)
    extent = positions(df, order[0])[1]
    levels = max(1, math.ceil(math.log2(max(2, extent // width)) / FAN_LOG2))
    rows = _numbered(df, key, order, spec, width)

    i = F.col("_r").bitwiseAND(F.lit((1 << lg) - 1))
    maps = _Maps(recs, len(spec.lag_cols), spec.max_lag)
    out, final = rows, {}
    if recs:
        w = Window.partitionBy("_k", "_b", F.shiftright("_r", lg)).orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
        loc = {}
        for k, r in enumerate(recs):
            if r.decay == 1.0:
                loc[f"_loc{k}"] = F.sum(F.lit(r.weight) * F.col(r.src)).over(w)
            else:
                loc[f"_loc{k}"] = F.pow(F.lit(r.decay), i) * F.sum(F.pow(F.lit(r.decay), -i) * (F.lit(r.weight) * F.col(r.src))).over(w)
        out = out.withColumns(loc)
    if recs or spec.lag_cols or spec.index_col:
        # an outer join: filters inferred from an inner one would part the two branches
        carries = _carries(_summaries(rows, recs, spec, lg), maps, levels)
        out = out.join(carries, (F.col("_k") == F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left")
    for k, r in enumerate(recs):
        decayed = "" if r.decay == 1.0 else f"pow({r.decay!r}D, (_r & {(1 << lg) - 1}) + 1) * "
        final[r.out] = F.expr(f"_loc{k} + {decayed}_at[int(shiftright(_r, {lg}))].c{k}")
    for r in spec.recurrences:
        if r.decay <= 0.0:
            final[r.out] = F.col(r.src)
    for j, c in enumerate(spec.lag_cols):
        for k in range(1, spec.max_lag + 1):
            final[f"{c}_lag{k}"] = F.expr(f"if(_r >= {k}, `_{c}_l{k}`, get(_in.h{j}, int(size(_in.h{j}) - ({k} - _r))))")
    if spec.index_col:
        final[spec.index_col] = F.expr("_in.n + _r")
    frames = [f"{f.out}_{x}" for f in spec.frames for x in ("sum", "count")]
    return out.withColumns(final).select(*df.columns, *frames, *final)
