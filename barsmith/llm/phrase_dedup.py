"""Substring dedup with automata of recurring phrases.

Words covered by a window of 50 words that also starts in a document with a
smaller id are removed.  Windows are judged on the input; equal means equal word
sequences.

1. Every chunk of documents sends the hashes of its anchors (runs of eight words,
   see ``repeats``) to ranges, which answer which are in two documents or more.
2. Every chunk compiles an Aho-Corasick automaton of its recurring phrases, as
   sequences of words, and streams all its documents through it.  An anchor that
   the automaton finds marks its windows as candidates; their 96-bit hashes go to
   ranges with the least id that holds them in the chunk, and one bit comes back
   for each: whether another chunk has a smaller id.
3. Every chunk removes the words that such windows cover.

An automaton holds the phrases of one chunk, so its size is bounded by the
chunk's and no document meets a phrase that it cannot hold.

Defined cases: a null text has no words; documents under 50 words keep all; a
document's own repeats stay; equal ids do not remove each other; a null id counts
as larger than all others; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import materialise
from barsmith.llm.repeats import (RANGE_ROWS, Powers, Runs, U, bits_of, by_range, chunks, covered, load, pack,
                                  recurring, repeated_runs, split_ranges)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WINDOW, PHRASE = 50, 8


class Chunk:
    """Words, runs and windows of a chunk."""

    def __init__(self, blob: bytes, window: int = WINDOW, phrase: int = PHRASE):
        self.ids, self.null, sizes, data = load(blob)
        ends = np.cumsum(sizes).tolist()
        raw = data.tobytes()
        self.words = [WORD.findall(raw[e - n:e].decode("utf-8", "surrogatepass")) for e, n in zip(ends, sizes.tolist())]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        known: dict[str, int] = {}
        self.codes = np.fromiter((known.setdefault(w, len(known)) for ws in self.words for w in ws), np.int64, int(self.sizes.sum()))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in known), U, len(known))
        self.units = hashes[self.codes] if len(known) else np.zeros(0, U)
        self.window, self.phrase = window, phrase
        self.runs = Runs(self.units, self.sizes, window, phrase)

    def located(self, often: np.ndarray) -> np.ndarray:
        """Which runs have an anchor where the automaton of the recurring phrases finds one."""
        runs, k = self.runs, self.phrase
        machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for p in runs.anchor[often].tolist():
            machine.add_word(tuple(self.codes[p:p + k].tolist()), 1)
        hit = np.zeros(len(self.codes) + 1, bool)
        if len(machine):
            machine.make_automaton()
            at = 0
            for n in self.sizes.tolist():
                if n >= self.window:
                    ends = [end for end, _ in machine.iter(tuple(self.codes[at:at + n].tolist()))]
                    hit[np.array(ends, np.int64) + (at - k + 1)] = True
                at += n
        return hit[runs.anchor]

    def candidates(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of the runs found: (index, line of their hash); and the sorted distinct 64-bit and 32-bit hashes' first
        index and least id."""
        runs = self.runs
        pick = np.repeat(found, runs.last - runs.first)
        index = np.flatnonzero(pick)
        start = runs.start[index]
        one = runs.powers.of(start, start + self.window)
        two = Powers(self.units, U(0xC2B2AE3D27D4EB4F)).of(start, start + self.window) >> U(32) if len(index) else one
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        line = np.empty(len(order), np.int64)
        line[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        owner = self.ids[runs.doc[index]]
        least = np.minimum.reduceat(owner[order], at) if len(at) else np.zeros(0, np.int64)
        return index, line, np.stack([a[at], b[at]]), least


def _decide(blobs: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
    """For each window of each chunk whether a smaller id than the chunk's least has it."""
    a = np.concatenate([x["one"] for x in blobs])
    b = np.concatenate([x["two"] for x in blobs])
    least = np.concatenate([x["ids"][x["owner"]] for x in blobs])
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    at = np.flatnonzero(new)
    top = np.minimum.reduceat(least[order], at)
    smaller = np.empty(len(order), bool)
    smaller[order] = np.repeat(top, np.diff(np.append(at, len(order)))) < least[order]
    return np.split(smaller, np.cumsum([len(x["one"]) for x in blobs])[:-1])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """(id, n_words, n_removed, kept): every document with the words that are kept, joined by one space."""
    table = chunks(docs, id_col, text_col)
    ranges = max(12, int((table.agg(F.sum("n_bytes")).first()[0] or 0) / 6 * 0.05 / RANGE_ROWS * 4) + 1)
    flags = recurring(table, lambda blob: (lambda c: (c.ids, c.runs))(Chunk(blob, window, phrase)), ranges)

    def locate(chunk_rows: pa.Table, flag_rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {"part": [], "chunk": [], "blob": []}
        for chunk, blob in zip(chunk_rows.column("chunk").to_pylist(), chunk_rows.column("blob")):
            c = Chunk(blob.as_py(), window, phrase)
            found = c.located(repeated_runs(c.runs, c.ids, flag_rows, ranges))
            _, _, hashes, least = c.candidates(found)
            cuts, used = split_ranges(hashes[0], 64, ranges)
            for r in used.tolist():
                s = slice(cuts[r], cuts[r + 1])
                ids, own = np.unique(least[s], return_inverse=True)
                out["part"].append(r)
                out["chunk"].append(chunk)
                out["blob"].append(pack(one=hashes[0][s], two=hashes[1][s].astype(np.uint32), owner=own.astype(np.int32), ids=ids))
        return pa.table({"part": pa.array(out["part"], pa.int32()), "chunk": pa.array(out["chunk"], pa.int64()), "blob": pa.array(out["blob"], pa.binary())})

    def remove(chunk_rows: pa.Table, answer_rows: pa.Table) -> pa.Table:
        flag_rows = answer_rows.filter(pc.equal(answer_rows.column("kind"), 0))
        answers = answer_rows.filter(pc.equal(answer_rows.column("kind"), 1))
        parts = []
        for blob in chunk_rows.column("blob"):
            c = Chunk(blob.as_py(), window, phrase)
            index, line, hashes, least = c.candidates(repeated_runs(c.runs, c.ids, flag_rows, ranges))
            cuts, _ = split_ranges(hashes[0], 64, ranges)
            smaller = bits_of(answers, cuts)
            gone = smaller[line] | (c.ids[c.runs.doc[index]] > least[line]) if len(index) else np.zeros(0, bool)
            out = covered(c.runs.start[index[gone]], window, len(c.codes))
            ends = np.cumsum(c.sizes)
            removed = np.diff(np.concatenate([[0], np.cumsum(out)])[np.concatenate([[0], ends])])
            kept = []
            for ws, end, n, r in zip(c.words, ends.tolist(), c.sizes.tolist(), removed.tolist()):
                kept.append(" ".join(ws) if not r else " ".join([w for w, o in zip(ws, out[end - n:end].tolist()) if not o]))
            parts.append(pa.table({"id": pa.array(c.ids, mask=c.null), "n_words": pa.array(c.sizes), "n_removed": pa.array(removed, pa.int64()),
                                   "kept": pa.array(kept, pa.string())}))
        return pa.concat_tables(parts) if parts else pa.table({"id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})

    sent = table.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(locate, "part int, chunk long, blob binary")
    answers = materialise(by_range(sent, _decide), "smaller")
    known = flags.withColumn("kind", F.lit(0)).unionByName(answers.withColumn("kind", F.lit(1)))
    return table.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(remove, "id long, n_words long, n_removed long, kept string")
