"""Near duplicates by Order MinHash, verified by banded alignment.

A text is its lower-case words; its k-mers are runs of five words (a shorter text
is one k-mer), each labelled with how often it occurred before in the text.  For
each of ``bands`` hash functions a sketch takes the two labelled k-mers of least
hash and keeps them in the order of the text, so texts agree in a sketch if they
share k-mers in the same order.  Texts that agree in a band are candidates.

Two texts are linked if a banded alignment of their k-mers (longest common
subsequence, order kept) has ``common / (a + b - common) >= 0.8``.  The band is
as wide as the similarity allows, so the bound on the result is exact.  Classes
are the connected components of the links.

Copies (equal words) form one class member, of least id.  Buckets are narrow rows
(id, key); a bucket is compared as a star around the member that occurs in most
company.  A bucket whose members are then still in different components is
compared in full: small ones as pairs, large ones as pairs of blocks of bounded
size, each a group of its own that returns verified links only.  There, two members
are compared once, in the first band that they share, and not if they are known to
be connected; their shared k-mers, counted for many members at once, reject most.
No bucket is dropped and no bucket is collected; k-mers are joined to the pairs and
blocks that need them.  Texts are not shuffled for that: a bitmap of bounded size,
over hashes of the ids that share a bucket, tells which texts are read again, and an
exact join drops the k-mers of those that it let through by chance.

Defined cases: texts without words (null, empty, blank) are linked to nothing;
rows with a null id are left out; an id that occurs twice is one document with
that of its texts whose digest is least; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import materialise, prepare, slices

SHINGLE, SIMILARITY, BANDS = 5, 0.8, 12
#: Members up to which a bucket is compared as pairs, members of a block of a larger one; words remembered by a task.
SMALL, BLOCK, MEMO = 32, 512, 400_000
#: k-mers looked up at a time when one member of a block is compared with the others.
COUNTED = 1 << 18
#: Bits for an id in the bitmap of wanted ids, the most in all (16 MB), and those of one row of it.
ID_BITS, MOST_BITS, ROW_BITS = 32, 1 << 27, 1 << 15
U = np.uint64
ODD = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Words:
    """Hashes of words, remembered from text to text."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts in a row, and the number of each."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        split = [t.lower().split() if t else [] for t in texts]
        memo = self.memo
        for w in {w for ws in split for w in ws}.difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        sizes = np.array([len(ws) for ws in split], np.int64)
        return np.fromiter((memo[w] for ws in split for w in ws), U, int(sizes.sum())), sizes


def kmers(words: np.ndarray, sizes: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """k-mer hashes of all texts in a row, and the number of each (one for a text of 1 to k words)."""
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    starts = np.cumsum(sizes) - sizes
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    lengths = np.repeat(np.minimum(sizes, k), counts)
    h = np.zeros(len(first), U)
    for j in range(k):
        w = words[np.minimum(first + j, len(words) - 1)] if len(words) else np.zeros(0, U)
        h = np.where(j < lengths, mix(h * ODD + w), h)
    return h, counts


def label(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """k-mer hashes that also tell the how-manieth occurrence in its text it is."""
    doc = np.repeat(np.arange(len(counts), dtype=U), counts)
    key = h ^ mix(doc + ODD)
    order = np.argsort(key, kind="stable")
    run = key[order]
    new = np.ones(len(run), bool)
    new[1:] = run[1:] != run[:-1]
    at = np.arange(len(run))
    nth = np.empty(len(run), U)
    nth[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(U)
    return mix(h + nth * U(0xD6E8FEB86659FD93))


def sketches(h: np.ndarray, counts: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A key for each text with k-mers and each band."""
    full = np.flatnonzero(counts)
    sizes = counts[full]
    starts = np.cumsum(sizes) - sizes
    out = np.zeros((len(full), bands), U)
    if not len(full):
        return out
    labelled = label(h, counts)

    def least(x: np.ndarray) -> np.ndarray:
        hit = np.flatnonzero(x == np.repeat(np.minimum.reduceat(x, starts), sizes))
        owner = np.searchsorted(starts, hit, side="right") - 1
        return hit[np.unique(owner, return_index=True)[1]]

    for b in range(bands):
        x = mix(labelled ^ mix(np.array([b + 1], U) * ODD))
        one = least(x)
        x[one] = U(0xFFFFFFFFFFFFFFFF)
        two = least(x)
        lo, hi = np.minimum(one, two), np.maximum(one, two)
        out[:, b] = mix(labelled[lo] * ODD + labelled[hi])
    return out


def common_in_order(a: list[int], b: list[int], width: int) -> int:
    """Longest common subsequence of ``a`` and ``b`` with places at most ``width`` apart.

    One bit for each place of the band; an addition carries along a row of the alignment.
    """
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    bits = 2 * width + 1
    mask = (1 << bits) - 1
    v, low, done = mask, -width, 0               # bit p stands for place low + p of a
    for x in b:
        hits = 0
        for i in where.get(x, ()):
            if 0 <= i - low < bits:
                hits |= 1 << (i - low)
        if hits:
            u = v & hits
            v = ((v + u) | (v - u)) & mask
        done += 1 - (v & 1)
        v = (v >> 1) | (1 << (bits - 1))
        low += 1
    return done + bits - v.bit_count()


def bag(seq: list[int]) -> set[int]:
    """k-mers of 32 bits with the number of their earlier occurrences above."""
    out = set(seq)
    if len(out) < len(seq):
        seen: dict[int, int] = {}
        for x in seq:
            n = seen[x] = seen.get(x, -1) + 1
            if n:
                out.add(x + (n << 32))
    return out


def may_link(a: set[int], b: set[int], least: float = SIMILARITY) -> bool:
    """Whether two bags share enough k-mers in any order, which is never fewer than in the same order."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    common = len(a & b)
    return common >= least * (len(a) + len(b) - common) - 1e-9


def similarity(a: list[int], b: list[int], least: float = SIMILARITY) -> float:
    """Shared k-mers in order by all k-mers; 0 if that is surely under ``least``."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    # common >= least * (n + m) / (1 + least), so at most this many k-mers of either side have no partner
    width = int(max(n, m) - least * (n + m) / (1 + least) + 1e-9) + 1
    common = common_in_order(a, b, width)
    return common / (n + m - common)


def digests(words: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128-bit digests of the words of some texts."""
    ends = np.cumsum(sizes)
    return [xxhash.xxh128_digest(words[ends[i] - sizes[i]:ends[i]].tobytes()) for i in at]


def sketch(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS) -> DataFrame:
    """(id, digest, n, keys) of the texts that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in slices(batch, "text"):
                flat, sizes = words.flat(part.column("text").to_pylist())
                h, counts = kmers(flat, sizes)
                full = np.flatnonzero(counts)
                keys = sketches(h, counts, bands).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(full)), pa.array(digests(flat, sizes, full), pa.binary()), pa.array(sizes[full], pa.int64()), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["id", "digest", "n", "keys"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null").mapInArrow(
        run, "id long, digest binary, n long, keys array<long>")


def likely(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id is in ``wanted``, and few others; rows stay where they are.

    One bit for each hash of an id; with more ids than the bitmap is made for, more
    others stay, and none that is wanted is lost.
    """
    n = wanted.agg(F.approx_count_distinct("id")).first()[0]
    rows = max(1, min(MOST_BITS, ID_BITS * n) // ROW_BITS)
    spot = F.pmod(F.xxhash64("id", F.lit("bitmap")), F.lit(rows * ROW_BITS))
    row, bit = (spot / ROW_BITS).cast("int"), (spot % ROW_BITS).cast("int")
    bitmap = wanted.groupBy(row.alias("row")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    placed = texts.withColumn("row", row).withColumn("bit", bit)
    byte = F.conv(F.hex(F.expr("substring(bits, bit div 8 + 1, 1)")), 16, 10).cast("int")
    return placed.join(F.broadcast(bitmap), "row").where(F.getbit(byte, F.col("bit") % 8) == 1).select(*texts.columns)


def sequences(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """(id, seq): the k-mers, 32 bits each, of the documents in ``wanted``; of an id's texts the one that is sketched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in slices(batch, "text"):
                flat, sizes = words.flat(part.column("text").to_pylist())
                h, counts = kmers(flat, sizes)
                small = (h >> U(32)).astype(np.uint32)
                ends, full = np.cumsum(counts), np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(full)), pa.array(digests(flat, sizes, full), pa.binary()),
                     pa.array([small[ends[i] - counts[i]:ends[i]].tobytes() for i in full], pa.binary())], names=["id", "digest", "seq"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return (likely(texts, wanted).mapInArrow(run, "id long, digest binary, seq binary")
            .groupBy("id").agg(F.min_by("seq", "digest").alias("seq")).join(wanted.select("id"), "id", "left_semi"))


def verify(pairs: DataFrame, seqs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of the pairs that are linked."""
    left = seqs.select(F.col("id").alias("a"), F.col("seq").alias("sa"))
    right = seqs.select(F.col("id").alias("b"), F.col("seq").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            last, a, a_bag = None, [], set()
            for x, y, sa, sb in zip(*(batch.column(c) for c in ("a", "b", "sa", "sb"))):
                if last != x.as_py():
                    last, a = x.as_py(), np.frombuffer(sa.as_py(), np.uint32).tolist()
                    a_bag = bag(a)
                b = np.frombuffer(sb.as_py(), np.uint32).tolist()
                if may_link(a_bag, bag(b), least) and (s := similarity(a, b, least)) >= least:
                    rows.append((last, y.as_py(), s))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))],
                                             names=["a", "b", "similarity"])

    la, lb = F.octet_length("sa"), F.octet_length("sb")
    near = pairs.join(left, "a").join(right, "b").where(F.least(la, lb) >= least * F.greatest(la, lb))
    return near.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of the ids in ``edges`` (a, b): the least id of each connected component.

    Every round takes the least label among the neighbours and then the label of
    the label, so that distances halve.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = (both.join(labels.withColumnsRenamed({"id": "b", "comp": "c"}), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c")))
        step = labels.join(near, "id").select("id", "comp", F.least("comp", "c").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        fresh = materialise(step.join(jump, "next", "left").select("id", "comp", F.least("next", F.coalesce("far", "next")).alias("next")), "labels")
        if fresh.where("comp <> next").isEmpty():
            return labels
        labels = fresh.select("id", F.col("next").alias("comp"))


def compare_blocks(large: DataFrame, keys: DataFrame, seqs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Verified links between members of large buckets (bucket, band, id, comp, n) that are in different components."""
    mine = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).cast("int")
    held = (large.select("bucket", "band", "id", "comp", mine.alias("mine"), F.ceil(F.col("n") / BLOCK).alias("blocks")).join(keys, "id").join(seqs, "id")
            .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
            .select("bucket", "band", "id", "comp", "mine", "keys", "seq", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))

    def run(group: pa.Table) -> pa.Table:
        band, i, j = (group.column(c)[0].as_py() for c in ("band", "i", "j"))
        ids, mine = group.column("id").to_numpy(), group.column("mine").to_numpy()
        own = group.column("keys").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        texts = [np.frombuffer(x.as_py(), np.uint32) for x in group.column("seq")]
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        # the k-mers of all bags, one bag after the other, as places in a mark of all distinct ones
        kinds, held_kmers = np.unique(np.concatenate([np.fromiter(bag(t.tolist()), np.int64, len(t)) for t in texts]), return_inverse=True)
        mark = np.zeros(len(kinds), np.int32)
        comp = group.column("comp").to_pylist()
        known = np.array(comp)
        root = {c: c for c in comp}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        def may_link_to(x: int, ys: np.ndarray) -> np.ndarray:
            """Those of ``ys`` whose bags share enough k-mers with that of ``x``."""
            own_kmers = held_kmers[starts[x]:starts[x] + sizes[x]]
            mark[own_kmers] = 1
            out = []
            for some in np.array_split(ys, 1 + int(sizes[ys].sum()) // COUNTED):
                if len(some):
                    n = sizes[some]
                    first = np.cumsum(n) - n
                    common = np.add.reduceat(mark[held_kmers[np.repeat(starts[some] - first, n) + np.arange(int(n.sum()))]], first)
                    out.append(some[common >= least * (sizes[x] + n - common) - 1e-9])
            mark[own_kmers] = 0
            return np.concatenate(out)

        rows = []
        right = np.arange(len(ids)) if i == j else np.flatnonzero(mine == j)
        for x in range(len(ids)) if i == j else np.flatnonzero(mine == i).tolist():
            ys = right[right > x] if i == j else right
            ys = ys[(known[ys] != known[x]) & (sizes[x] > 0) & (np.minimum(sizes[ys], sizes[x]) >= least * np.maximum(sizes[ys], sizes[x]))]
            ys = ys[(own[ys] == own[x]).argmax(1) == band]               # all share this band; is it the first?
            if not len(ys):
                continue
            for y in may_link_to(x, ys).tolist():
                if find(comp[x]) != find(comp[y]) and (s := similarity(texts[x].tolist(), texts[y].tolist(), least)) >= least:
                    rows.append((min(ids[x], ids[y]), max(ids[x], ids[y]), s))
                    root[find(comp[x])] = find(comp[y])
        return pa.table({"a": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.int64()),
                         "similarity": pa.array([r[2] for r in rows], pa.float64())})

    # few bytes, much work: a given number of partitions is not coalesced by size
    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return held.repartition(parts, "bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long, similarity double")


def link(reps: DataFrame, docs: DataFrame, id_col: str, text_col: str, least: float = SIMILARITY) -> DataFrame:
    """Verified links (a, b, similarity) between class members (id, keys): enough of them to connect every class."""
    rows = reps.select("id", F.posexplode("keys").alias("band", "key")).withColumn("bucket", F.xxhash64("band", "key"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(rows.select("bucket", "band", "id").join(sizes, "bucket"), "buckets")
    company = shared.groupBy("id").agg(F.sum("n").alias("company"))
    buckets = materialise(shared.join(company, "id"), "buckets")
    seqs = materialise(sequences(docs, id_col, text_col, buckets.select("id").distinct()), "kmers")
    # a star around the member that is found in most company
    top = F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("top")
    leaders = buckets.groupBy("bucket").agg(top).select("bucket", (-F.col("top.minus")).alias("leader"))
    stars = (buckets.join(leaders, "bucket").where("id <> leader")
             .select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct())
    links = materialise(verify(stars, seqs, least), "links")
    held = buckets.join(components(links), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = held.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    apart = materialise(held.select("bucket", "band", "id", "comp", "n").join(mixed, "bucket"), "apart")
    small = apart.where(F.col("n") <= SMALL)
    other = small.select("bucket", F.col("id").alias("b"), F.col("comp").alias("comp2"))
    pairs = small.join(other, "bucket").where("id < b and comp <> comp2").select(F.col("id").alias("a"), "b").distinct()
    more = verify(pairs, seqs, least)
    blocks = compare_blocks(apart.where(F.col("n") > SMALL), reps.select("id", "keys"), seqs, least)
    return links.unionByName(materialise(more, "links")).unionByName(materialise(blocks, "links")).groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, bands: int = BANDS) -> DataFrame:
    """(id, class_id, rep_id, n_links): the least id of the document's class, the least id with the same
    words, and that member's links among those that connect the class.  Every non-null id has one row."""
    spark = docs.sparkSession
    prepare(spark)
    rows = materialise(sketch(docs, id_col, text_col, bands).groupBy("id").agg(F.min(F.struct("digest", "n", "keys")).alias("s")).select("id", "s.*"), "sketches")
    reps = materialise(rows.groupBy("digest", "n").agg(F.min("id").alias("id"), F.min("keys").alias("keys")), "members")
    links = materialise(link(reps, docs, id_col, text_col, least), "links")
    degree = (links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links")))
    members = (reps.select("id", "digest", "n").join(components(links), "id", "left").join(degree, "id", "left")
               .select(F.col("id").alias("rep_id"), "digest", "n", F.coalesce("comp", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    known = rows.select("id", "digest", "n").join(members, ["digest", "n"]).select("id", "class_id", "rep_id", "n_links")
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    return (ids.join(known, "id", "left")
            .select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("rep_id", "id").alias("rep_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
