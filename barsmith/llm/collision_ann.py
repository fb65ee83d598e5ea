"""Approximate nearest neighbours by collision counting over single projections.

Vectors are put on a unit sphere of one dimension more, where the nearest point
is the one of largest inner product.  Every shard of vectors keeps, for each side
of each random projection, lists of the vectors that reach far out there.  A query
counts on the projections where it reaches farthest itself; a vector collides once
for each of their windows that holds it.  The vectors with most collisions are
verified by their inner product in double precision, and the k-th best of them is
a bound.  Given the query's places, a vector of some inner product lies in each
window with a known probability, whatever the data are; all vectors with as many
collisions as one at the bound has but for ``SLACK`` deviations are verified.  If
these are too many, or that number is below one, the windows are widened round by
round (virtual rehashing); after the last round everything is verified.

Equal vectors are searched once: candidates are distinct vectors with the
smallest ids that have them, queries are distinct vectors joined back to their
rows, so no group of copies is expanded.  Queries meet every shard in blocks of
bounded size; each pair of shard and block is a group of its own.

Defined cases: rows whose id or vector is null, whose vector is empty, zero or
holds a null or a number that is not finite take no part; vectors are compared
with vectors of their length; a row that repeats (same id and vector) is one;
equal scores are ranked by smaller id; with fewer than k candidates all are
returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import materialise, prepare

#: Projections in all, those that a query counts on, and the lower edges of a window in each round.
PROJECTIONS, COUNTED, EDGES = 1024, 128, (1.5, 1.0, 0.5)
#: Deviations below the expected collisions of the k-th best at which a vector is still verified.
SLACK = 2.0
#: Vectors verified first for a bound, as a multiple of k; share of a shard that is verified without a wider window.
FULLEST, FEW = 2, 0.5
#: Vectors of a shard, queries of a block, and groups of both at least.
SHARD_ROWS, BLOCK_ROWS, GROUPS = 32_768, 8_192, 8
#: Projections that are computed at a time.
STRIP = 64
#: The normal distribution function, by linear interpolation.
GRID = np.linspace(-8.0, 8.0, 4097)
NORMAL = np.array([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in GRID])


class ShardIndex:
    """Lists of a shard's vectors that reach far out on a projection, for each projection, side and round."""

    def __init__(self, vectors: np.ndarray, scale: float, seed: int = 11):
        self.vectors, self.scale = vectors, scale
        unit = vectors / scale
        rest = np.sqrt(np.maximum(0.0, 1 - (unit * unit).sum(1)))
        self.lifted = np.column_stack([unit, rest]).astype(np.float32)
        self.axes = np.random.default_rng(seed).standard_normal((unit.shape[1] + 1, PROJECTIONS))
        self.rings: list[tuple[list[int], np.ndarray]] = []

    def ring(self, at: int) -> tuple[list[int], np.ndarray]:
        """Starts and lines of the lists between the edges of round ``at`` and of the one before: the upper sides, then the lower ones."""
        while len(self.rings) <= at:
            inner, outer = EDGES[len(self.rings)], EDGES[len(self.rings) - 1] if self.rings else np.inf
            sizes: tuple[list, list] = ([], [])
            lines: tuple[list, list] = ([], [])
            for j in range(0, PROJECTIONS, STRIP):
                own = self.axes[:, j:j + STRIP].T.astype(np.float32) @ self.lifted.T
                for side in (0, 1):
                    held = (own >= inner) & (own < outer) if side == 0 else (own <= -inner) & (own > -outer)
                    sizes[side].append(held.sum(1))
                    lines[side].append(np.nonzero(held)[1].astype(np.int32))
            starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes[0] + sizes[1]))])
            self.rings.append((starts.tolist(), np.concatenate(lines[0] + lines[1])))
        return self.rings[at]

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the lines of verified vectors that can be among the k best, and their inner products."""
        n, dim = self.vectors.shape
        norms = np.linalg.norm(queries, axis=1)
        for query, norm in zip(queries, norms):
            own = (query / norm) @ self.axes[:dim]
            far = np.argpartition(np.abs(own), PROJECTIONS - COUNTED)[-COUNTED:]
            out = np.abs(own[far])
            lists = np.where(own[far] >= 0, far, far + PROJECTIONS).tolist()
            counts, known = 0, np.zeros(n, bool)
            found: list[np.ndarray] = []
            scores: list[np.ndarray] = []

            def verify(lines: np.ndarray) -> None:
                fresh = lines[~known[lines]]
                known[fresh] = True
                found.append(fresh)
                scores.append(np.einsum("ij,j->i", self.vectors[fresh], query))

            for at, edge in enumerate(EDGES):
                starts, lines = self.ring(at)
                counts = counts + np.bincount(np.concatenate([lines[starts[j]:starts[j + 1]] for j in lists]), minlength=n)
                # a bound from the vectors with most collisions
                at_least = np.cumsum(np.bincount(counts)[::-1])[::-1]
                level = int(np.count_nonzero(at_least >= FULLEST * k)) - 1
                if level < 1:
                    continue
                verify(np.flatnonzero(counts >= level))
                s = np.concatenate(scores)
                bound = min(np.partition(s, len(s) - k)[len(s) - k] / (norm * self.scale), 1.0)
                # given the query's place on an axis, a vector's place is normal around bound times it, axis by axis independent
                p = np.interp((bound * out - edge) / math.sqrt(max(1 - bound * bound, 1e-12)), GRID, NORMAL)
                expected = p.sum() - SLACK * math.sqrt((p * (1 - p)).sum())
                need = math.ceil(expected) if expected > 0 else 0
                if need and (need >= len(at_least) or at_least[need] <= FEW * n):
                    if need < level:
                        verify(np.flatnonzero(counts >= need))
                    break
            else:
                verify(np.arange(n))
            yield np.concatenate(found), np.concatenate(scores)


def usable(vector: str) -> Column:
    """The vector as array<double> where it takes part, else null."""
    v = F.col(vector).cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(v, lambda x: x + F.lit(0.0)))


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, itself excluded."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), usable(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
            .where("id is not null and v is not null").distinct())
    rows = materialise(rows.withColumn("key", F.concat_ws("|", F.size("v"), F.hex(F.xxhash64("v")), F.hex(F.hash("v")))), "vectors")
    # the k + 1 smallest ids of each distinct vector are all that any answer needs
    first = Window.partitionBy("key").orderBy("id")
    ids = rows.select("key", "id", "v").withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    groups = materialise(ids.groupBy("key").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
                         .withColumn("dim", F.size("v")), "distinct-vectors")
    asked = rows.where("q").groupBy("key").agg(F.first("v").alias("v")).withColumn("dim", F.size("v"))
    asked = materialise(asked, "distinct-queries")
    n, top = groups.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    # few large shards: the k-th best of more vectors is nearer and fewer collide as often
    shards = max(1, -(-n // SHARD_ROWS))
    blocks = max(-(-GROUPS // shards), -(-asked.count() // BLOCK_ROWS))
    scale = float(top or 1.0) * (1 + 1e-12)
    spread = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    held = groups.withColumn("shard", F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(shards)).cast("int")).withColumn("block", spread)
    sent = (asked.withColumn("block", F.pmod(F.xxhash64("key", F.lit("block")), F.lit(blocks)).cast("int"))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
        return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)

    def meet(own: pa.Table, queries: pa.Table) -> pa.Table:
        out_key: list[str] = []
        out_id: list[np.ndarray] = []
        out_score: list[np.ndarray] = []
        if own.num_rows and queries.num_rows:
            dim = own.column("dim")[0].as_py()
            index = ShardIndex(matrix(own.column("v"), dim), scale)
            members = own.column("ids").to_pylist()
            keys = queries.column("key").to_pylist()
            for key, (lines, scores) in zip(keys, index.search(matrix(queries.column("v"), dim), k + 1)):
                if len(lines) > k + 1:                                 # ties at the border stay
                    keep = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                    lines, scores = lines[keep], scores[keep]
                got = sorted((-s, i) for line, s in zip(lines.tolist(), scores.tolist()) for i in members[line])[:k + 1]
                out_key += [key] * len(got)
                out_id.append(np.array([i for _, i in got], np.int64))
                out_score.append(np.array([-s for s, _ in got]))
        return pa.table({"key": pa.array(out_key, pa.string()), "vec_id": pa.array(np.concatenate(out_id) if out_id else [], pa.int64()),
                         "score": pa.array(np.concatenate(out_score) if out_score else [], pa.float64())})

    near = (held.groupBy("dim", "shard", "block").cogroup(sent.groupBy("dim", "shard", "block"))
            .applyInArrow(meet, "key string, vec_id long, score double"))
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    each = rows.where("q").select(F.col("id").alias("query_id"), "key").join(near, "key").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
