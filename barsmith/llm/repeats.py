"""What the operators on repeated passages share: chunks of documents, anchors, and the exchange of facts by hash.

Both look for windows of ``length`` units (words or bytes) that also start in a
document with a smaller id.  Texts never leave their chunk: a chunk is a row with
the compressed texts of consecutive documents of a partition.  What chunks have
to know of each other goes by hash ranges: a chunk sends each range the sorted
distinct hashes that fall into it, and gets one bit for each back.  A passage in
any number of documents is one entry for each chunk, so no hash is hot.

Anchors: of the runs of ``k`` units in a window the one of least hash (the first
of equals) is its anchor.  Equal windows have the same anchor at the same place,
so a window whose anchor is in no other document is in no other document.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import SLICE_BYTES, materialise, prepare, slices

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
#: What a null document id counts as: larger than all others.
NO_ID = np.iinfo(np.int64).max
#: Bits of a place in a chunk within a minimum's key, and hashes that one range gets at most on average.
PLACE_BITS, RANGE_ROWS = 28, 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one short binary value: a line that names them, then their bytes, compressed."""
    import zstandard
    held = {k: np.ascontiguousarray(v) for k, v in arrays.items()}
    head = " ".join(f"{k}:{v.dtype.str}:{len(v)}" for k, v in held.items()).encode() + b"\n"
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(v.tobytes() for v in held.values()))


def unpack(data: bytes) -> dict[str, np.ndarray]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = raw.index(b"\n") + 1
    out = {}
    for part in raw[:at - 1].decode().split():
        name, kind, n = part.split(":")
        out[name] = np.frombuffer(raw, kind, int(n), at)
        at += out[name].nbytes
    return out


def chunks(docs: DataFrame, id_col: str, text_col: str, limit: int = SLICE_BYTES) -> DataFrame:
    """(chunk, n_bytes, blob): all documents, about ``limit`` bytes of text in a row; a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit):
                texts = part.column("text").fill_null("")
                ids = part.column("id")
                blob = pack(id=ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64), null=ids.is_null().to_numpy(zero_copy_only=False).astype(bool),
                            size=pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64),
                            text=np.frombuffer("".join(texts.to_pylist()).encode("utf-8", "surrogatepass"), np.uint8))
                size = pc.sum(pc.binary_length(texts)).as_py() or 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([size], pa.int64()), pa.array([blob], pa.binary())],
                    names=["chunk", "n_bytes", "blob"])

    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialise(rows.mapInArrow(run, "chunk long, n_bytes long, blob binary"), "chunks", "uncompressed")


def load(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids (null: NO_ID), which are null, bytes of each text, and the bytes of all texts in a row."""
    got = unpack(blob)
    return got["id"], got["null"], got["size"], got["text"]


class Powers:
    """Polynomial hashes of any run of units: one sum for each prefix."""

    def __init__(self, units: np.ndarray, base: np.uint64 = BASE):
        n = len(units)
        inverse = pow(int(base), -1, 1 << 64)
        up = np.full(n + 1, base, U)
        up[0] = 1
        up = np.multiply.accumulate(up)
        self.down = np.full(n + 1, U(inverse), U)
        self.down[0] = 1
        self.down = np.multiply.accumulate(self.down)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(units * up[:-1], dtype=U)])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])


def sliding_argmin(key: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` consecutive hashes, the first of equals."""
    n = len(key)
    if n < width:
        return np.zeros(0, np.int32)
    packed = (key >> U(PLACE_BITS) << U(PLACE_BITS)) | np.arange(n, dtype=U)
    pad = -n % width
    blocks = np.concatenate([packed, np.full(pad, U(0xFFFFFFFFFFFFFFFF))]).reshape(-1, width)
    del packed
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n - width + 1], ahead[width - 1:n])
    del ahead, back, blocks
    return (least & U((1 << PLACE_BITS) - 1)).astype(np.int32)


class Runs:
    """Windows of the documents of a chunk, by runs of windows with the same anchor."""

    def __init__(self, units: np.ndarray, sizes: np.ndarray, length: int, k: int):
        """``units`` are hashes of the units of all documents in a row, ``sizes`` the units of each document."""
        if len(units) >= 1 << PLACE_BITS:
            raise ValueError("a chunk holds too many units")
        self.length = length
        self.powers = Powers(units)
        starts = np.cumsum(sizes) - sizes
        windows = np.maximum(sizes - length + 1, 0)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), windows)
        self.start = np.repeat((starts - (np.cumsum(windows) - windows)).astype(np.int32), windows) + np.arange(int(windows.sum()), dtype=np.int32)
        if not len(self.start):
            self.first = self.last = self.anchor = self.run_doc = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U)
            return
        at = np.arange(len(units) - k + 1)
        phrase = self.powers.of(at, at + k)
        least = sliding_argmin(phrase, length - k + 1)[self.start]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (self.doc[1:] != self.doc[:-1])
        #: indexes of the first window of each run, and after its last; the anchor's place and 48-bit hash,
        #: mixed anew: the least of many hashes are near 0, and ranges of them would be very uneven
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(least))
        self.anchor = least[self.first]
        self.hash = mix(phrase[self.anchor] ^ BASE) >> U(16)
        self.run_doc = self.doc[self.first]


def split_ranges(hashes: np.ndarray, bits: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Borders of the ranges in sorted hashes of ``bits`` bits, and the ranges that have any."""
    edges = np.array([(r << bits) // ranges for r in range(ranges)], dtype=object).astype(U)
    cuts = np.append(np.searchsorted(hashes, edges), len(hashes))
    return cuts, np.flatnonzero(np.diff(cuts))


def by_range(sent: DataFrame, decide: Callable[[list[dict[str, np.ndarray]]], list[np.ndarray]]) -> DataFrame:
    """(chunk, part, bits): for each row (part, chunk, blob) the bits that ``decide`` makes of all blobs of its part."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bits = decide([unpack(b.as_py()) for b in table.column("blob")])
        return pa.table({"chunk": table.column("chunk"), "part": table.column("part"),
                         "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())})

    return sent.groupBy("part").applyInArrow(run, "chunk long, part int, bits binary")


def recurring(chunk_table: DataFrame, runs_of: Callable[[bytes], tuple[np.ndarray, Runs]], ranges: int,
              weigh: Callable[[Runs], np.ndarray] | None = None, limit: int = 0) -> DataFrame:
    """(chunk, part, bits): which of a chunk's distinct anchor hashes, sorted, are in two documents or more.

    With ``weigh``, which gives each of them a weight, the bits of a part are followed
    by as many others: whose weights in all chunks come to more than ``limit``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob")):
                ids, runs = runs_of(blob.as_py())
                hashes, many = distinct_anchors(runs, ids)
                cuts, used = split_ranges(hashes, 48, ranges)
                weight = {} if weigh is None else {"weight": weigh(runs).astype(np.int32)}
                blobs = [pack(hash=hashes[cuts[r]:cuts[r + 1]], many=many[cuts[r]:cuts[r + 1]], **{k: v[cuts[r]:cuts[r + 1]] for k, v in weight.items()}) for r in used]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([chunk] * len(used), pa.int64()), pa.array(blobs, pa.binary())],
                                                 names=["part", "chunk", "blob"])

    def decide(blobs: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
        hashes = [b["hash"] for b in blobs]
        found, back, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        often = (counts > 1)[back] | np.concatenate([b["many"] for b in blobs])
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        if weigh is None:
            return np.split(often, ends)
        heavy = (np.bincount(back, np.concatenate([b["weight"] for b in blobs]), len(found)) > limit)[back]
        return [np.concatenate(x) for x in zip(np.split(often, ends), np.split(heavy, ends))]

    return materialise(by_range(chunk_table.select("chunk", "blob").mapInArrow(send, "part int, chunk long, blob binary"), decide), "recurring")


def distinct_anchors(runs: Runs, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct anchor hashes of a chunk, and which are in documents with different ids."""
    if not len(runs.hash):
        return np.zeros(0, U), np.zeros(0, bool)
    order = np.argsort(runs.hash, kind="stable")
    h, owner = runs.hash[order], ids[runs.run_doc[order]]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    at = np.flatnonzero(new)
    return h[at], np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at)


def bits_of(flags: pa.Table, cuts: np.ndarray, after: bool = False) -> np.ndarray:
    """The bits of a chunk's rows (part, bits) one after the other; ``cuts`` are the borders of the parts.
    ``after``: the second half of bits that come in two halves."""
    out = np.zeros(int(cuts[-1]), bool)
    for part, bits in zip(flags.column("part").to_pylist(), flags.column("bits").to_pylist()):
        n = int(cuts[part + 1] - cuts[part])
        out[cuts[part]:cuts[part + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * n if after else n)[n if after else 0:]
    return out


def repeated_runs(runs: Runs, ids: np.ndarray, flags: pa.Table, ranges: int, heavy: bool = False) -> np.ndarray:
    """Which runs have an anchor that recurs; ``heavy``: one whose weights exceed the limit."""
    hashes, _ = distinct_anchors(runs, ids)
    cuts, _ = split_ranges(hashes, 48, ranges)
    often = bits_of(flags, cuts, heavy)
    return often[np.searchsorted(hashes, runs.hash)] if len(hashes) else np.zeros(0, bool)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` units a window of ``length`` units that begins at one of ``starts`` covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0
