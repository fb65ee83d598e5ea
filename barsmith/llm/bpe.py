"""Byte-level BPE encoding and decoding by DuckDB recursive queries in the tasks.

The pre-token pattern cuts texts in the scan (JVM).  Each task keeps the distinct
pre-tokens of its partition and merges only those: a DuckDB recursive query holds
one row per (word, place, token), joins neighbours with the merge table and
contracts the leftmost pair of least rank of every word until no pair is left.
Decoding is an ordered aggregation of the tokens' bytes.  The vocabulary is read
from a rank file (base64 token and rank a line) named by a parameter.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated
rows are encoded each; an id outside the vocabulary fails the decoding.  Words
follow the Unicode tables of the JVM; no text is normalised.

Memory in a task: one slice of pre-tokens, a bounded memo, one block of words in
DuckDB (whose own memory is limited and spills to the task's temporary folder).
"""

from __future__ import annotations

import base64
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import plus, prepare

#: Words and bytes that one recursive query merges, pre-tokens handled at a time, words remembered.
BLOCK_WORDS, BLOCK_BYTES, SLICE_PIECES, MEMO = 40_000, 600_000, 1_000_000, 400_000
#: Contractions in one recursive query; longer words go through several.
STEPS = 32

MERGE_SQL = f"""
CREATE OR REPLACE TEMP TABLE merged AS
WITH RECURSIVE step(word, place, token, done, n) AS (
    SELECT word, place, token, false, 0 FROM start
  UNION ALL
    (WITH live AS (
        SELECT word, place, token, n, word::BIGINT * 4294967296 + place AS at
        FROM step WHERE NOT done AND n < {STEPS}),
     best AS (      -- the least (rank, place) of each word
        SELECT a.word AS of_word, min(merges.rank_high + a.place) AS pick
        FROM live a JOIN live b ON b.at = a.at + 1
             JOIN merges ON merges.pair = a.token::BIGINT * 4194304 + b.token
        GROUP BY a.word)
     SELECT word,
            CASE WHEN place > pick % 4294967296 THEN place - 1 ELSE place END,
            CASE WHEN place = pick % 4294967296 THEN (pick // 4294967296)::INT ELSE token END,
            pick IS NULL, n + 1
     FROM live LEFT JOIN best ON word = of_word
     WHERE pick IS NULL OR place <> pick % 4294967296 + 1)
)
SELECT word, place, token, done FROM step WHERE done OR n = {STEPS}
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Vocabulary and merge table in a DuckDB connection of one worker."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb
        self.ranks = ranks
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": tempfile.gettempdir()})
        self.byte = np.full(256, -1, np.int32)
        pairs, high = [], []
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte[token[0]] = rank
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left * 4194304 + right)
                    high.append(rank * 4294967296)
        self._load("merges", pair=pa.array(pairs, pa.int64()), rank_high=pa.array(high, pa.int64()))
        self._load("vocabulary", id=pa.array(list(ranks.values()), pa.int32()), hexes=pa.array([t.hex() for t in ranks], pa.string()))
        self.memo: dict[str, int] = {}
        self.reset()

    def _load(self, name: str, **columns: pa.Array) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def reset(self) -> None:
        """Forget the remembered words."""
        self.memo.clear()
        self.ids = [np.zeros(0, np.int32)]        # tokens of remembered words, one after the other
        self.sizes = [np.zeros(0, np.int64)]
        self.bytes: list[bytes] = []

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words in a row, and how many each has."""
        known = [self.ranks.get(w) for w in words]
        whole = np.array([k is not None for k in known], bool)
        out_w = [np.flatnonzero(whole)]
        out_p = [np.zeros(whole.sum(), np.int64)]
        out_t = [np.array([k for k in known if k is not None], np.int32)]
        rest = np.flatnonzero(~whole)
        lengths = np.array([len(words[i]) for i in rest], np.int64)
        flat = np.frombuffer(b"".join(words[i] for i in rest), np.uint8)
        word = np.repeat(rest, lengths).astype(np.int32)
        place = (np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        token = self.byte[flat]
        if (token < 0).any():
            raise ValueError("the vocabulary lacks a single byte")
        while len(word):
            self._load("start", word=pa.array(word), place=pa.array(place), token=pa.array(token))
            self.con.execute(MERGE_SQL)
            got = self.con.execute("SELECT * FROM merged").fetchnumpy()
            done = np.asarray(got["done"], bool)
            for to, name in ((out_w, "word"), (out_p, "place"), (out_t, "token")):
                to.append(np.asarray(got[name])[done])
            word, place, token = (np.asarray(got[c])[~done].astype(np.int32) for c in ("word", "place", "token"))
        w, p, t = np.concatenate(out_w), np.concatenate(out_p), np.concatenate(out_t)
        order = np.lexsort((p, w))
        return t[order].astype(np.int32), np.bincount(w, minlength=len(words)).astype(np.int64)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Bytes of runs of ids that lie one after the other, by ordered aggregation."""
        run = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self._load("runs", run=pa.array(run), place=pa.array(np.arange(len(ids), dtype=np.int32)), id=pa.array(ids.astype(np.int32)))
        got = self.con.execute("SELECT run, string_agg(hexes, '' ORDER BY place) AS hexes, count(*) = count(hexes) AS whole "
                               "FROM runs LEFT JOIN vocabulary USING (id) GROUP BY run").fetchnumpy()
        if not np.asarray(got["whole"], bool).all():
            raise ValueError("an id is not in the vocabulary")
        out = [b""] * len(sizes)
        for r, h in zip(got["run"].tolist(), got["hexes"].tolist()):
            out[r] = bytes.fromhex(h)
        return out

    def lines(self, words: list[str], decode: bool) -> np.ndarray:
        """Places of words in the memo; new ones are merged, in blocks, first."""
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.reset()
            new = words
        new = sorted(set(new), key=lambda w: (len(w), w))
        at = 0
        while at < len(new):
            end, held, block = at, 0, []
            while end < len(new) and len(block) < BLOCK_WORDS and (held < BLOCK_BYTES or not block):
                block.append(new[end].encode("utf-8", "surrogatepass"))
                held += len(block[-1])
                end += 1
            ids, sizes = self.merge(block)
            if decode:
                self.bytes.extend(self.decode(ids, sizes))
            first = len(self.memo)
            self.memo.update(zip(new[at:end], range(first, first + len(block))))
            self.ids.append(ids)
            self.sizes.append(sizes)
            at = end
        return np.fromiter((self.memo[w] for w in words), np.int64, len(words))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All remembered tokens, and where each word begins and how many it has."""
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        sizes = self.sizes[0]
        return self.ids[0], np.cumsum(sizes) - sizes, sizes


_CODECS: dict[int, Codec] = {}


def _codec(ranks: dict[bytes, int]) -> Codec:
    """The worker's codec, kept from task to task; one vocabulary at a time."""
    if id(ranks) not in _CODECS:
        _CODECS.clear()
        _CODECS[id(ranks)] = Codec(ranks)
    return _CODECS[id(ranks)]


def _list_slices(column: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Row ranges of a list column with about SLICE_PIECES items, one row at least."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > SLICE_PIECES:
            yield start, i - start
            start, held = i, 0
        held += int(n)
    if len(sizes) > start:
        yield start, len(sizes) - start


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``flat`` one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", packed: bool = False, round_trip: bool = False) -> DataFrame:
    """``docs`` without the text, with ``ids`` (array<int>; packed: binary of little-endian unsigned 32-bit
    integers) and, for ``round_trip``, ``decoded``: the bytes that the ids decode to; in place of columns of these names."""
    spark = docs.sparkSession
    docs = docs.drop("ids", "decoded")
    prepare(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(rank_file))
    pieces = F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))
    cut = docs.withColumn(text_col, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value)
        codec.reset()
        for batch in batches:
            for start, n in _list_slices(batch.column(text_col)):
                part = batch.slice(start, n)
                column = part.column(text_col)
                coded = column.flatten().dictionary_encode()
                per_doc = np.diff(column.offsets.to_numpy(zero_copy_only=False))
                words = coded.dictionary.to_pylist()
                line = codec.lines(words, round_trip)[coded.indices.to_numpy(zero_copy_only=False)]
                ids, first, sizes = codec.tables()
                tokens = _gather(ids, first[line], sizes[line])
                ends = np.cumsum(per_doc)
                counts = np.concatenate([[0], np.cumsum(sizes[line])])[np.concatenate([[0], ends])].astype(np.int32)
                if packed:
                    out = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((counts * 4).astype(np.int32)), pa.py_buffer(tokens.astype("<u4"))])
                else:
                    out = pa.ListArray.from_arrays(pa.array(counts), pa.array(tokens))
                columns = [*part.drop_columns([text_col]).columns, out]
                names = [*(c for c in part.schema.names if c != text_col), "ids"]
                if round_trip:
                    known, got, at = codec.bytes, line.tolist(), 0
                    texts = []
                    for end in ends.tolist():
                        texts.append(b"".join([known[i] for i in got[at:end]]))
                        at = end
                    columns.append(pa.array(texts, pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = "binary" if packed else "array<int>"
    return cut.mapInArrow(run, plus(docs, f"ids {kind}" + ", decoded binary" * round_trip, drop=text_col))


def decode(tokens: DataFrame, rank_file: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` without the ids (array<int>; null: none), with ``decoded``: their bytes, by ordered aggregation."""
    spark = tokens.sparkSession
    tokens = tokens.drop("decoded") if ids_col != "decoded" else tokens
    prepare(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value)
        for batch in batches:
            for start, n in _list_slices(batch.column(ids_col)):
                part = batch.slice(start, n)
                lists = part.column(ids_col).to_pylist()
                sizes = np.array([len(x or ()) for x in lists], np.int64)
                flat = np.array([i for x in lists for i in x or ()], np.int32)
                out = pa.array(codec.decode(flat, sizes), pa.binary())
                names = [*(c for c in part.schema.names if c != ids_col), "decoded"]
                yield pa.RecordBatch.from_arrays([*part.drop_columns([ids_col]).columns, out], names=names)

    return tokens.mapInArrow(run, plus(tokens, "decoded binary", drop=ids_col))
