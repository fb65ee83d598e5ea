"""Toxicity by a factorization machine over hashed terms.

A text is the set of hash buckets of its case-folded words and their beginnings
of four to six characters.  Its logit is

    w0 + sum_j w_j + 1/2 * (|sum_j v_j|^2 - sum_j |v_j|^2)

where the last term adds the inner product of the factors of every two terms of
the text, so a pair such as an insult and the mention of a group can weigh more
than both words alone.  The fit uses a bounded sample of labelled rows; scoring
runs over all texts in the tasks of one scan, without a shuffle.

Defined cases: a null or empty text has the bias as its logit; rows with a null
label are not learned from; a document labelled twice counts with its larger
label; repeated documents are scored each; without both classes among the
labels every score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import append, first_by_hash, materialise, plus, prepare, slices

WORD = re.compile(r"\w+")
BUCKETS = 1 << 20
STEMS = (4, 5, 6)
#: Words whose bucket a task remembers at a time.
MEMO = 400_000


def terms_of(word: str) -> list[int]:
    """Hash buckets of a case-folded word and, so that inflected forms share evidence, of its longer beginnings."""
    forms = [word, *("^" + word[:n] for n in STEMS if len(word) > n)]
    return [zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in forms]


def term_buckets(text: str | None) -> set[int]:
    """Hash buckets of the terms of a text."""
    return {b for w in set(WORD.findall((text or "").casefold())) for b in terms_of(w)}


@dataclass
class FactorizationMachine:
    """``rows[bucket]`` is the feature's line in ``w`` and ``v``; line 0 is "not a feature"."""

    rows: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Logit of each text; ``flat`` holds feature lines, ``starts`` where each text begins."""
        ends = np.append(starts[1:], len(flat))
        pad = np.append(flat, 0)                                  # reduceat needs an element at every start
        w = np.add.reduceat(self.w[pad], starts)
        v = self.v[pad]
        s, q = np.add.reduceat(v, starts), np.add.reduceat((v * v).sum(1), starts)
        out = self.w0 + w + 0.5 * ((s * s).sum(1) - q)
        return np.where(ends > starts, out, self.w0)


def informative(counts: DataFrame, n1: int, n0: int, min_gain: float, max_features: int) -> np.ndarray:
    """Sorted buckets whose presence tells about the label: log-likelihood ratio of ``min_gain`` or more, the largest
    first.  ``counts`` has a row (bucket, ones, n) for each bucket: texts of label 1 and all texts that hold it."""
    n = float(n1 + n0)

    def term(seen: Column, share: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / share)).otherwise(F.lit(0.0))

    one, both = F.col("ones").cast("double"), F.col("n").cast("double")
    gain = 2 * (term(one, both * n1 / n) + term(both - one, both * n0 / n)
                + term(n1 - one, (n - both) * n1 / n) + term(n0 - (both - one), (n - both) * n0 / n))
    best = (counts.where("n >= 2").select("bucket", gain.alias("gain")).where(F.col("gain") >= min_gain)
            .orderBy(F.desc("gain"), "bucket").limit(max_features))
    return np.array(sorted(r[0] for r in best.collect()), np.int64)


def fit_machine(lines: list[np.ndarray], y: np.ndarray, features: np.ndarray, factors: int = 4, epochs: int = 30,
                rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """AdaGrad over mini-batches of the logistic loss, both classes weighted alike.  ``lines`` are the texts' features
    as places in ``features``, from 1."""
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return FactorizationMachine(np.zeros(BUCKETS, np.int32), odds, np.zeros(1), np.zeros((1, factors)))
    rng = np.random.default_rng(seed)
    rows = np.zeros(BUCKETS, np.int32)
    rows[features] = np.arange(1, len(features) + 1)
    m = FactorizationMachine(rows, 0.0, np.zeros(len(features) + 1), rng.normal(0, 0.01, (len(features) + 1, factors)))
    m.v[0] = 0
    sw, sv, s0 = np.full_like(m.w, 1e-8), np.full_like(m.v, 1e-8), 1e-8
    cost = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(lines))
        for at in range(0, len(order), 128):
            pick = order[at:at + 128]
            sizes = np.array([len(lines[i]) for i in pick])
            flat = np.concatenate([lines[i] for i in pick]) if sizes.sum() else np.zeros(0, np.int32)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
            p = 1 / (1 + np.exp(-np.clip(m.logits(flat, starts), -30, 30)))
            g = (p - y[pick]) * cost[pick] / len(pick)
            s0 += g.sum() ** 2
            m.w0 -= rate * g.sum() / np.sqrt(s0)
            if not len(flat):
                continue
            per = np.repeat(g, sizes)
            v = m.v[flat]
            total = np.add.reduceat(np.vstack([v, np.zeros((1, factors))]), starts)
            total[sizes == 0] = 0
            gv = per[:, None] * (np.repeat(total, sizes, axis=0) - v)
            seen, back = np.unique(flat, return_inverse=True)
            dw = np.bincount(back, weights=per) + decay * m.w[seen]
            dv = np.stack([np.bincount(back, weights=gv[:, f]) for f in range(factors)], 1) + decay * m.v[seen]
            sw[seen] += dw ** 2
            sv[seen] += dv ** 2
            m.w[seen] -= rate * dw / np.sqrt(sw[seen])
            m.v[seen] -= 0.5 * rate * dv / np.sqrt(sv[seen])
    return m


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_rows_per_class: int = 8_000, min_gain: float = 12.0, max_features: int = 16_384) -> FactorizationMachine:
    """Fit on at most ``max_rows_per_class`` labelled documents of each class, taken by the hash of their id.

    The bound makes the sample's ids small enough to broadcast; the choice by
    hash does not depend on the order of rows.  Features are counted and chosen
    by Spark, so that the driver gets only the chosen ones of each sampled text.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    sample = first_by_hash(known, "y", "id", max_rows_per_class)
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(sample), "id").select("id", "y", "text"))

    rows = materialise(rows, "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tally: dict[int, list[int]] = {}
                for y, text in zip(part.column("y").to_pylist(), part.column("text").to_pylist()):
                    for b in term_buckets(text):
                        c = tally.setdefault(b, [0, 0])
                        c[0] += y
                        c[1] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(tally), pa.int32()), pa.array([c[0] for c in tally.values()], pa.int64()),
                     pa.array([c[1] for c in tally.values()], pa.int64())], names=["bucket", "ones", "n"])

    size = {r[0]: r[1] for r in rows.groupBy("y").count().collect()}
    counts = (rows.select("y", "text").mapInArrow(count, "bucket int, ones long, n long")
              .groupBy("bucket").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")))
    features = informative(counts, size.get(1, 0), size.get(0, 0), min_gain, max_features)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                got = [np.searchsorted(features, np.intersect1d(features, list(term_buckets(t)))) + 1 for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("y"), pa.array(got, pa.list_(pa.int32()))], names=["id", "y", "lines"])

    got = rows.mapInArrow(lines, "id long, y int, lines array<int>").toPandas().sort_values("id", kind="stable")
    return fit_machine([np.asarray(x, np.int64) for x in got["lines"]], got["y"].to_numpy(float), features)


def score(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All rows of ``docs`` with the probability of label 1 in ``out_col``, in place of a column of that name."""
    spark = docs.sparkSession
    docs = docs.drop(out_col)
    prepare(spark)
    shared = spark.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        memo: dict[str, tuple[int, ...]] = {}
        rows = m.rows
        for batch in batches:
            for part in slices(batch, text_col):
                flat: list[int] = []
                starts: list[int] = []
                for text in part.column(text_col).to_pylist():
                    starts.append(len(flat))
                    if not text:
                        continue
                    found: set[int] = set()
                    for w in set(WORD.findall(text.casefold())):
                        r = memo.get(w)
                        if r is None:
                            r = memo[w] = tuple(x for x in rows[terms_of(w)].tolist() if x)
                        if r:
                            found.update(r)
                    flat.extend(sorted(found))
                    if len(memo) > MEMO:
                        memo.clear()
                z = m.logits(np.array(flat, np.int64), np.array(starts, np.int64))
                yield append(part, **{out_col: pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))), pa.float64())})

    return docs.mapInArrow(run, plus(docs, f"{out_col} double"))
