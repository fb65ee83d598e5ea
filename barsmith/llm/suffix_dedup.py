"""Exact substring dedup over bytes with suffix arrays.

Bytes covered by a 50-byte string that also starts in a document with a smaller
id are removed; strings never cross documents and are judged on the input.

Only text around recurring anchors (runs of 20 bytes, see ``repeats``) can repeat
for 50 bytes.  A chunk cuts it into contexts, the bytes of all windows that share
an anchor, and sends each distinct context with the least id that holds it to the
shard of the anchor's hash.  Equal windows have equal anchors, so they meet in
one shard.  A shard builds the suffix array of its distinct contexts by induced
sorting: suffixes are classified, substrings between leftmost smaller suffixes
are sorted and named, the named text is sorted recursively, and the array is
induced from it in two passes over the buckets.  Permuted common prefixes with
the predecessor show which windows are equal; each window learns whether a
smaller id holds it, and one bit for each goes back to the chunks.

An anchor with more than ``HOT`` contexts (a common line in ever different
surroundings) would make one shard and array grow with the corpus.  Its windows
part: each goes by its own 64-bit hash to any of the shards, which tell equal ones
by it.  Which anchors are hot is counted over all chunks, so all chunks agree.

Defined cases: a null text is empty; a document's own repeats stay; equal ids do
not remove each other; a null id counts as larger than all others; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import materialise
from barsmith.llm.repeats import (RANGE_ROWS, Powers, Runs, U, bits_of, by_range, chunks, covered, load, mix, pack,
                                  recurring, repeated_runs, split_ranges)

WINDOW, PHRASE = 50, 20
#: Names up to which the recursion induces by bucket; texts with more are sorted by doubling.
MAX_BUCKETS = 2_048
#: Bytes of text in a chunk, of all text for each shard, and of the contexts that one suffix array holds (an anchor's stay together).
CHUNK_BYTES, SHARD_BYTES, ARRAY_BYTES = 1 << 20, 2 << 20, 256 << 10
#: Contexts, each chunk's distinct ones, up to which an anchor's go to one array.
HOT = 3_000


def _types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one (the last, a unique least sign, counts as such)."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    next_change = np.minimum.accumulate(at[::-1])[::-1]
    smaller = np.ones(n, bool)
    smaller[:-1] = np.append(step, 1)[next_change] > 0
    return smaller


def _deal(chars: np.ndarray, items: np.ndarray, to: list[list[np.ndarray]]) -> None:
    """Append items to the lists of their characters, in order."""
    order = np.argsort(chars, kind="stable")
    sorted_chars, sorted_items = chars[order], items[order]
    cuts = np.flatnonzero(np.diff(sorted_chars)) + 1
    begin = 0
    for end in [*cuts.tolist(), len(order)]:
        to[sorted_chars[begin]].append(sorted_items[begin:end])
        begin = end


def _induce(text: np.ndarray, smaller: np.ndarray, size: int, lms: np.ndarray) -> np.ndarray:
    """Suffix array from leftmost smaller suffixes in order: larger suffixes from the left, smaller ones from the right."""
    seeds: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(text[lms], lms, seeds)
    waiting: list[list[np.ndarray]] = [[] for _ in range(size)]
    large: list[list[np.ndarray]] = [[] for _ in range(size)]

    def spread(items: np.ndarray, want_smaller: bool, own: int) -> np.ndarray:
        """Deal the predecessors of one type; those of the same bucket are returned."""
        before = items[items > 0] - 1
        before = before[smaller[before] == want_smaller]
        chars = text[before]
        here = before[chars == own]
        if len(here) < len(before):
            rest = chars != own
            _deal(chars[rest], before[rest], waiting)
        return here

    for c in range(size):
        batch = np.concatenate(waiting[c]) if waiting[c] else None
        waiting[c] = []
        while batch is not None and len(batch):
            large[c].append(batch)
            batch = spread(batch, False, c)
        for seed in seeds[c]:
            spread(seed, False, -1)
    out: list[np.ndarray] = []
    for c in range(size - 1, -1, -1):
        batch = np.concatenate(waiting[c]) if waiting[c] else None
        waiting[c] = []
        while batch is not None and len(batch):
            out.append(batch)
            batch = spread(batch, True, c)
        if c == 0:
            out.append(np.array([len(text) - 1], np.int64))
        for part in reversed(large[c]):
            back = part[::-1]
            out.append(back)
            spread(back, True, -1)
        if c == 0:
            break
    return np.concatenate(out)[::-1]


def _by_doubling(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by doubling the compared length."""
    rank = text.astype(np.int64)
    n, width = len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * (int(after.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        width *= 2
        if rank[order[-1]] == n - 1 or width >= n:
            return order


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Order of the suffixes of ``text`` (values under ``size``), whose last sign is 0 and nowhere else."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    smaller = _types(text)
    is_lms = smaller.copy()
    is_lms[1:] &= ~smaller[:-1]
    is_lms[0] = False
    lms = np.flatnonzero(is_lms)
    first = _induce(text, smaller, size, lms)
    order = first[is_lms[first]]                       # sorted by the substring up to the next one
    stop = np.full(n, n, np.int64)
    stop[lms[:-1]] = lms[1:] + 1
    sums = Powers(mix(text.astype(U) + U(1)))
    key = sums.of(order, stop[order]) ^ mix((stop[order] - order).astype(U))
    names = np.zeros(len(order), np.int64)
    names[1:] = np.cumsum(key[1:] != key[:-1])
    if names[-1] + 1 < len(names):
        named = np.empty(n, np.int64)
        named[order] = names
        reduced = named[lms]
        inner = suffix_array(reduced, int(names[-1]) + 1) if names[-1] < MAX_BUCKETS else _by_doubling(reduced)
        order = lms[inner]
    return _induce(text, smaller, size, order)


def permuted_prefixes(data: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """For each suffix the bytes that it shares with its predecessor in the array, at most ``cap``, in text order."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    padded = np.concatenate([data.astype(np.uint8), np.zeros(cap + 16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(padded) - 7, 8), (1, 1))
    live = np.flatnonzero(before >= 0)
    for at in range(0, cap, 8):
        if not len(live):
            break
        differs = words[live + at] != words[before[live] + at]
        same = np.where(differs.any(1), differs.argmax(1), 8)
        room = np.minimum(n - np.maximum(live, before[live]) - at, cap - at)
        out[live] += np.minimum(same, room)
        live = live[(same == 8) & (room > 8)]
    return out


def smaller_owner(contexts: np.ndarray, sizes: np.ndarray, least: np.ndarray, window: int) -> np.ndarray:
    """For each window of each context (distinct contexts one after the other) the least id of all contexts that hold it."""
    n = int(sizes.sum())
    ends = np.cumsum(sizes)
    text = np.zeros(n + len(sizes) + 1, np.int64)
    place = np.arange(n) + np.repeat(np.arange(len(sizes)), sizes)      # one sign between contexts
    text[place] = contexts.astype(np.int64) + 2
    text[ends + np.arange(len(sizes))] = 1
    order = suffix_array(text, 258)
    data = np.where(text >= 2, text - 2, 0).astype(np.uint8)
    shared = permuted_prefixes(data, order, window)
    starts = ends - sizes
    per = sizes - window + 1
    where = np.repeat(starts + np.arange(len(sizes)) - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
    line = np.full(len(text), -1, np.int64)
    line[where] = np.arange(len(where))
    owner = np.repeat(least, per)
    # a stretch of the array whose suffixes share the window with their predecessors holds one window
    joined = shared[order] >= window
    real = line[order] >= 0
    joined[1:] &= real[1:] & real[:-1]
    picked = np.flatnonzero(real)
    at = line[order[picked]]
    new = ~joined[picked]
    new[0] = True
    heads = np.flatnonzero(new)
    low = np.minimum.reduceat(owner[at], heads)
    out = np.empty(len(where), np.int64)
    out[at] = np.repeat(low, np.diff(np.append(heads, len(at))))
    return out


class Chunk:
    """Bytes, runs and contexts of a chunk."""

    def __init__(self, blob: bytes, window: int = WINDOW, phrase: int = PHRASE):
        self.ids, self.null, self.sizes, self.data = load(blob)
        table = mix(np.arange(256, dtype=U) + U(1))
        self.window = window
        self.runs = Runs(table[self.data], self.sizes, window, phrase)

    def keys(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of runs the borders and the hash of their contexts."""
        runs = self.runs
        begin = runs.start[runs.first[index]]
        end = runs.start[runs.last[index] - 1] + self.window
        return begin, end, runs.powers.of(begin, end) ^ mix((end - begin).astype(U)) if len(index) else np.zeros(0, U)

    def weights(self) -> np.ndarray:
        """How many distinct contexts each of the sorted distinct anchor hashes has."""
        hashes, back, counts = np.unique(self.runs.hash, return_inverse=True, return_counts=True)
        index = np.flatnonzero(counts[back] > 1)
        if len(index):
            key, anchor = self.keys(index)[2], back[index]
            order = np.lexsort((key, anchor))
            k, h = key[order], anchor[order]
            new = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]))
            counts = np.where(counts > 1, np.bincount(h[new], minlength=len(hashes)), counts)
        return counts

    def contexts(self, found: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the runs found: their indexes, the line of each one's context, and of the distinct contexts, sorted by anchor:
        the index of a run that has it, the anchor hash, the context's hash, the least id."""
        runs = self.runs
        index = np.flatnonzero(found)
        key = self.keys(index)[2]
        order = np.lexsort((key, runs.hash[index]))
        k, h = key[order], runs.hash[index][order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
        line = np.empty(len(order), np.int64)
        line[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        least = np.minimum.reduceat(self.ids[runs.run_doc[index]][order], at) if len(at) else np.zeros(0, np.int64)
        return index, line, index[order[at]], h[at], k[at], least

    def lone(self, found: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the windows of the runs found: their indexes, the line of each one's hash, and the sorted distinct hashes with
        the least id."""
        runs = self.runs
        index = np.flatnonzero(np.repeat(found, runs.last - runs.first))
        start = runs.start[index]
        hashes, line = np.unique(runs.powers.of(start, start + self.window), return_inverse=True) if len(index) else (np.zeros(0, U), index)
        least = np.full(len(hashes), np.iinfo(np.int64).max)
        np.minimum.at(least, line, self.ids[runs.doc[index]])
        return index, line, hashes, least


def _gather(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return data[np.repeat(begin - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def _decide(window: int):
    def run(blobs: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
        """For each window of each context of each chunk whether a smaller id than the chunk's least has it.

        Equal contexts are one.  An anchor with one context needs no more; the
        contexts of the others go through suffix arrays, some anchors at a time.
        Then the same for each lone window of each chunk.
        """
        return [np.concatenate(x) for x in zip(of_contexts(blobs), of_lone(blobs))]

    def of_lone(blobs: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
        least = np.concatenate([b["lone_least"] for b in blobs])
        hashes, line = np.unique(np.concatenate([b["lone"] for b in blobs]), return_inverse=True)
        low = np.full(len(hashes), np.iinfo(np.int64).max)
        np.minimum.at(low, line, least)
        return np.split(low[line] < least, np.cumsum([len(b["lone"]) for b in blobs])[:-1])

    def of_contexts(blobs: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
        data, sizes, least, key, anchor = (np.concatenate([b[c] for b in blobs]) for c in ("data", "sizes", "least", "key", "anchor"))
        sizes = sizes.astype(np.int64)
        if not len(sizes):
            return [np.zeros(0, bool) for _ in blobs]
        begin = np.cumsum(sizes) - sizes
        order = np.lexsort((key, anchor))
        new = np.ones(len(order), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
        line = np.empty(len(order), np.int64)
        line[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        head = order[at]                                                 # distinct contexts, sorted by anchor
        low = np.minimum.reduceat(least[order], at)
        per = sizes[head] - window + 1
        first = np.cumsum(per) - per
        own = np.repeat(low, per)
        group = anchor[head]
        edge = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        several = np.repeat(np.diff(np.append(edge, len(group))) > 1, np.diff(np.append(edge, len(group))))
        pick = np.flatnonzero(several)
        batch = np.cumsum(sizes[head[pick]]) // ARRAY_BYTES
        # a batch ends with an anchor
        batch = batch[np.searchsorted(group[pick], group[pick], side="left")] if len(pick) else batch
        for i in np.unique(batch):
            some = pick[batch == i]
            got = smaller_owner(_gather(data, begin[head[some]], sizes[head[some]]), sizes[head[some]], low[some], window)
            own[_gather(np.arange(len(own)), first[some], per[some])] = got
        counts = sizes - window + 1
        smaller = _gather(own, first[line], counts) < np.repeat(least, counts)
        ends = np.cumsum([int((b["sizes"].astype(np.int64) - window + 1).sum()) for b in blobs])
        return np.split(smaller, ends[:-1])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): every document with the bytes that are kept."""
    table = chunks(docs, id_col, text_col, CHUNK_BYTES)
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(12, int(total * 0.07 / RANGE_ROWS) + 1)
    shards = max(12, total // SHARD_BYTES + 1)

    def opened(blob: bytes) -> tuple[np.ndarray, Runs]:
        c = Chunk(blob, window, phrase)
        c.runs.weights = c.weights()
        return c.ids, c.runs

    hot = HOT
    flags = recurring(table, opened, ranges, lambda runs: runs.weights, hot)

    def pieces(c: Chunk, flag_rows: pa.Table) -> tuple[tuple, tuple]:
        """What a chunk asks about: contexts, and the lone windows of hot anchors."""
        often, heavy = (repeated_runs(c.runs, c.ids, flag_rows, ranges, x) for x in (False, True))
        return c.contexts(often & ~heavy), c.lone(often & heavy)

    def send(chunk_rows: pa.Table, flag_rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {"part": [], "chunk": [], "blob": []}
        for chunk, blob in zip(chunk_rows.column("chunk").to_pylist(), chunk_rows.column("blob")):
            c = Chunk(blob.as_py(), window, phrase)
            (_, _, run, hashes, keys, least), (_, _, lone, lone_least) = pieces(c, flag_rows)
            (cuts, used), (lone_cuts, lone_used) = split_ranges(hashes, 48, shards), split_ranges(lone, 64, shards)
            for r in np.union1d(used, lone_used).tolist():
                s, alone = slice(cuts[r], cuts[r + 1]), slice(lone_cuts[r], lone_cuts[r + 1])
                own = run[s]
                begin = c.runs.start[c.runs.first[own]]
                sizes = c.runs.start[c.runs.last[own] - 1] + window - begin
                out["part"].append(r)
                out["chunk"].append(chunk)
                out["blob"].append(pack(data=_gather(c.data, begin, sizes), sizes=sizes.astype(np.int32), least=least[s], key=keys[s], anchor=hashes[s],
                                        lone=lone[alone], lone_least=lone_least[alone]))
        return pa.table({"part": pa.array(out["part"], pa.int32()), "chunk": pa.array(out["chunk"], pa.int64()), "blob": pa.array(out["blob"], pa.binary())})

    def remove(chunk_rows: pa.Table, answer_rows: pa.Table) -> pa.Table:
        flag_rows = answer_rows.filter(pc.equal(answer_rows.column("kind"), 0))
        answers = answer_rows.filter(pc.equal(answer_rows.column("kind"), 1))
        rows: dict[str, list] = {"id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for blob in chunk_rows.column("blob"):
            c = Chunk(blob.as_py(), window, phrase)
            runs = c.runs
            (index, line, run, hashes, _, least), (lone_index, lone_line, lone, lone_least) = pieces(c, flag_rows)
            per = runs.last[run] - runs.first[run]                       # windows of each distinct context
            first = np.cumsum(per) - per
            cuts, _ = split_ranges(hashes, 48, shards)
            window_cuts = np.append(first, per.sum())[cuts]
            lone_cuts, _ = split_ranges(lone, 64, shards)
            bits = bits_of(answers, window_cuts + lone_cuts)             # of each shard: contexts' windows, then lone ones
            smaller = bits[np.arange(window_cuts[-1]) + np.repeat(lone_cuts[:-1], np.diff(window_cuts))]
            lone_smaller = bits[np.arange(len(lone)) + np.repeat(window_cuts[1:], np.diff(lone_cuts))]
            counts = runs.last[index] - runs.first[index]
            gone = _gather(smaller, first[line], counts) | np.repeat(c.ids[runs.run_doc[index]] > least[line], counts)
            starts = runs.start[_gather(np.arange(len(runs.start)), runs.first[index], counts)][gone]
            lone_gone = lone_smaller[lone_line] | (c.ids[runs.doc[lone_index]] > lone_least[lone_line])
            starts = np.concatenate([starts, runs.start[lone_index[lone_gone]]])
            out = covered(starts, window, len(c.data))
            ends = np.cumsum(c.sizes)
            edges = np.diff(out.astype(np.int8), prepend=0) == 1
            heads = np.minimum(ends - c.sizes, max(len(out) - 1, 0))
            full = c.sizes > 0
            edges[heads[full]] = out[heads[full]]                        # a span ends with its document
            upto, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (out, edges))
            for i, (end, n) in enumerate(zip(ends.tolist(), c.sizes.tolist())):
                r = int(upto[end] - upto[end - n])
                raw = c.data[end - n:end]
                rows["id"].append(None if c.null[i] else int(c.ids[i]))
                rows["n_bytes"].append(n)
                rows["n_removed"].append(r)
                rows["n_spans"].append(int(spans[end] - spans[end - n]))
                rows["kept"].append((raw[~out[end - n:end]] if r else raw).tobytes())
        return pa.table({k: pa.array(v, pa.binary() if k == "kept" else pa.int64()) for k, v in rows.items()})

    sent = table.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(send, "part int, chunk long, blob binary")
    answers = materialise(by_range(sent, _decide(window)), "smaller")
    known = flags.withColumn("kind", F.lit(0)).unionByName(answers.withColumn("kind", F.lit(1)))
    return table.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(remove, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
