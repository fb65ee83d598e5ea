"""Best-fit packing of tokenised documents, in bulk-synchronous supersteps.

``pieces`` turns texts into ids with the tokenizers library, adds the end id and
cuts what is longer than a sequence.  A worker keeps the ids of the terms that it has
met (a bounded number), since white space always ends a term in the vocabulary used here.

``pack`` deals the pieces to sequences:

1. The pieces are range-sorted by length, which gives each its rank among those of
   its length; nothing else about them is needed to match them, so a *run* of
   equal lengths (and of equal gaps) stands for all its rows.  There are at most
   ``capacity`` different lengths, however many rows.
2. A superstep range-partitions the runs of gaps and of waiting lengths, those above
   half the largest one, by size.  Every task
   sweeps its range from large to small: a length takes the least gap in reach that
   holds it (its successor), as many copies in one sequence as fit.  Where several
   want one gap, ranks decide: lower ranks get the lower sequence numbers.  What
   finds no gap in its own range goes on to the gaps that larger ranges left over.
3. The gaps that were filled come back with their new size, and the next superstep
   begins.  Where nothing could be matched, as many sequences are opened as the
   waiting pieces fill at least.
4. Each piece finds its run, and with its rank its sequence and its place there.

Sequences grow from the front, so places have no holes.  The runs, not the
pieces, are what the driver keeps between supersteps.

Defined cases: a null text counts as empty, which is the end id alone; null and
repeated ids, repeated rows and ties are rows like others; an empty table gives no
row; further columns are not looked at.  A text of any length is taken whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barsmith.llm.common import materialise, plus, prepare, slices

#: Text bytes that a task looks up at a time, and terms whose ids a worker keeps (about 200 bytes each).
TEXT_BYTES = 24 << 20
KEPT_TERMS = 600_000
#: Longer terms are encoded each time they occur.
KEPT_LETTERS = 64
#: Ranges of sizes that a superstep sweeps side by side.
RANGES = 4

# Fixed values of the vocabulary file: how it normalises and splits.  White space ends every word there.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same split for lower-case letters that NFC leaves alone: ASCII and the letters from U+00C0 to U+017F (but U+0130, whose lower case is two characters).
LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
SPLIT_PLAIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
PLAIN = re.compile(f"[!-~{LETTERS[3:]}]*")


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


BYTE_LETTERS = _byte_letters()


class Encoder:
    """Ids of texts as the tokenizers library gives them, special tokens' names being ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        normal, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        split = [p.get("pattern", {}).get("Regex") for p in pre.get("pretokenizers", []) if p["type"] == "Split"]
        #: White space separates words, so words can be encoded on their own.
        self.by_word = normal.get("normalizers") == NORMALIZERS and split == [SPLIT]
        self.terms: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _term(self, term: str) -> bytes:
        got = self.terms.get(term)
        if got is None:
            letters = term if term.isascii() else "".join([BYTE_LETTERS[b] for b in term.encode()])
            got = array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
            if len(term) <= KEPT_LETTERS:
                self.terms[term] = got
        return got

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of every word, little-endian unsigned 32-bit.

        Words of plain letters, digits and signs are split here and their terms
        looked up, or merged by the library's model; the library takes the others whole.
        """
        if len(self.terms) > KEPT_TERMS:
            self.terms.clear()
        plain, split, term = PLAIN.fullmatch, SPLIT_PLAIN.findall, self._term
        out = [term(w.lower()) if w.isascii() and w.isalpha() else b"".join(map(term, split(w.lower()))) if plain(w) else None for w in words]
        other = [i for i, got in enumerate(out) if got is None]
        for k in range(0, len(other), 1_000):
            part = other[k:k + 1_000]
            for i, got in zip(part, self._encode([words[i] for i in part])):
                out[i] = got
        return out

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text in turn."""
        if not self.by_word:
            for text in texts.to_pylist():
                yield np.frombuffer(self._encode([text])[0], dtype="<u4")
            return
        lists = pc.ascii_split_whitespace(texts)
        codes = lists.flatten().dictionary_encode()
        parts = self.of_words(codes.dictionary.to_pylist())
        size = np.array([len(p) >> 2 for p in parts], dtype=np.int64)
        start = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(parts), dtype="<u4")
        word = codes.indices.to_numpy(zero_copy_only=False)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            n = size[word[a:b]]
            shift = start[word[a:b]] - np.cumsum(n) + n
            yield ids[np.repeat(shift, n) + np.arange(n.sum())]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)


def pieces(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids and the end id, cut at ``capacity``."""
    prepare(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t"))
    names = ["id", "piece", "start", "length", "ids_crc32"]
    tail = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for received in batches:
            for batch in slices(received, "_t", TEXT_BYTES):
                out = []
                for row, ids in enumerate(coder.of_texts(batch.column("_t").fill_null(""))):
                    whole_ids = ids.tobytes() + tail
                    n = len(whole_ids) >> 2
                    for k, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        out.append((row, k, start, length, zlib.crc32(whole_ids[4 * start:4 * (start + length)])))
                row, *cols = (np.array(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(cols[0], pa.int32()),
                                                  *(pa.array(c, pa.int64()) for c in cols[1:])], names)

    return rows.mapInArrow(work, f"id {dict(rows.dtypes)['id']}, piece int, start long, length long, ids_crc32 long")


# A run is (size, first, count): pieces of one length by rank, or sequences of one gap by number.
# A match is (length, first rank, pieces, pieces a sequence, first sequence, gap before).
Run = tuple[int, int, int]


def sweep(items: list[Run], gaps: list[Run]) -> tuple[list[tuple], list[Run], list[Run], list[Run]]:
    """(matches, filled gaps, waiting items, untouched gaps): from the largest size down, the least untouched gap that holds a piece."""
    matches, filled, waiting = [], [], []
    gaps, open_ = sorted(gaps), []
    for size, first, count in sorted(items, key=lambda r: (-r[0], r[1])):
        while gaps and gaps[-1][0] >= size:
            open_.append(gaps.pop())
        while count and open_:
            gap, seq, n = open_.pop()
            take = gap // size
            full = min(n, count // take)
            for each, many in ((take, full), (count - take * full, int(full < n and full * take < count))):
                if many and each:
                    matches.append((size, first, many * each, each, seq, gap))
                    filled.append((gap - each * size, seq, many))
                    first, count, seq, n = first + many * each, count - many * each, seq + many, n - many
            if n:
                open_.append((gap, seq, n))
        if count:
            waiting.append((size, first, count))
    return matches, [f for f in filled if f[0]], waiting, open_ + gaps


_RUN = "kind int, size long, first long, count long, take long, seq long, gap long"
_ITEM, _GAP, _MATCH, _FILLED = range(4)


def _sweep_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sweeps the items and gaps of one task; matches and filled gaps pass."""
    rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    runs = {k: [r[1:4] for r in rows if r[0] == k] for k in (_ITEM, _GAP)}
    matches, filled, waiting, left = sweep(runs[_ITEM], runs[_GAP])
    out = [r for r in rows if r[0] in (_MATCH, _FILLED)] + [(_MATCH, *m) for m in matches]
    out += [(kind, *r, 0, 0, 0) for kind, some in ((_FILLED, filled), (_ITEM, waiting), (_GAP, left)) for r in some]
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 7
    names = [c.split()[0] for c in _RUN.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(cols)], names)


def superstep(spark: SparkSession, items: list[Run], gaps: list[Run], ranges: int = RANGES) -> tuple[list[tuple], list[Run], list[Run], list[Run]]:
    """``sweep`` over ranges of sizes side by side, then over what they leave; the same matches as one sweep over all."""
    runs = spark.createDataFrame(pa.Table.from_batches([_batch([(k, *r, 0, 0, 0) for k, some in ((_ITEM, items), (_GAP, gaps)) for r in some])]))
    swept = runs.repartitionByRange(ranges, "size").mapInArrow(_sweep_rows, _RUN)
    rows = [tuple(r) for r in swept.repartition(1).mapInArrow(_sweep_rows, _RUN).collect()]
    pick = lambda kind, end: [r[1:end] for r in rows if r[0] == kind]
    return pick(_MATCH, 7), pick(_FILLED, 4), pick(_ITEM, 4), pick(_GAP, 4)


def _joined(gaps: list[Run]) -> list[Run]:
    """Runs of one gap whose sequences follow each other, as one run."""
    out: list[Run] = []
    for size, first, count in sorted(gaps):
        if out and out[-1][0] == size and out[-1][1] + out[-1][2] == first:
            out[-1] = (size, out[-1][1], out[-1][2] + count)
        else:
            out.append((size, first, count))
    return out


def schedule(counts: dict[int, int], capacity: int, step) -> tuple[list[tuple], int]:
    """(matches, number of sequences) for ``counts`` pieces of each length; ``step`` sweeps items and gaps once.

    A superstep matches the waiting lengths above half the largest one; the
    shorter ones are left to fill what those leave over.
    """
    items = [(size, 0, n) for size, n in sorted(counts.items())]
    gaps: list[Run] = []
    matches: list[tuple] = []
    opened = 0
    while items:
        most = max(i[0] for i in items)
        now, later = [i for i in items if 2 * i[0] > most], [i for i in items if 2 * i[0] <= most]
        if max([g[0] for g in gaps], default=0) < min(i[0] for i in now):
            new = -(-sum(size * n for size, _, n in (now if opened else items)) // capacity)
            gaps, opened = gaps + [(capacity, opened, new)], opened + new
        got, filled, waiting, left = step(now, gaps)
        matches += got
        items = waiting + later
        # a gap below the least piece that waits is of no more use
        floor = min([i[0] for i in items], default=capacity)
        gaps = _joined([g for g in filled + left if g[0] >= floor])
    return matches, opened


def ranked(rows: DataFrame, length_col: str) -> DataFrame:
    """``rows`` with ``_rank``, their place from 0 among the rows of their length."""
    at = rows.withColumn("_row", F.monotonically_increasing_id())
    at = materialise(at, "pack-rows")
    at = at.repartitionByRange(length_col, "_row").sortWithinPartitions(length_col, "_row")
    at = materialise(at.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "pack-sorted")
    ends = at.groupBy(length_col, "_part").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(length_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(length_col, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"))
    return at.join(ends, [length_col, "_part"]).withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_row", "_part", "_at", "_shift")


def pack(rows: DataFrame, capacity: int = 4096, length_col: str = "length") -> DataFrame:
    """``rows``, whose lengths are 1 to ``capacity`` (below 2^18), with ``sequence_id`` and ``offset``; columns of these names are replaced."""
    spark = rows.sparkSession
    rows = rows.drop("sequence_id", "offset")
    prepare(spark)
    placed = ranked(rows, length_col)
    counts = {int(r[0]): r[1] for r in placed.groupBy(length_col).count().collect()}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths are 1 to {capacity}")
    matches, _ = schedule(counts, capacity, lambda items, gaps: superstep(spark, items, gaps))
    size, first, _, take, seq, gap = (np.array(c, dtype=np.int64) for c in zip(*sorted(matches))) if matches else [np.zeros(0, np.int64)] * 6
    key = size << 44 | first
    schema = plus(rows, "sequence_id long, offset long")
    kept = rows.columns

    def work(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (length_col, "_rank"))
            run = np.searchsorted(key, length << 44 | rank, side="right") - 1
            turn = rank - first[run]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(seq[run] + turn // take[run]),
                                              pa.array(capacity - gap[run] + turn % take[run] * length)], [*kept, "sequence_id", "offset"])

    return placed.select(*kept, "_rank").mapInArrow(work, schema)
