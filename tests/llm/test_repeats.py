"""Substring operators against brute force over all windows."""

import random
import re

import numpy as np
import pytest

from barsmith.llm import phrase_dedup, repeats, suffix_dedup
from llm_rows import docs, docs_rows, no_docs  # noqa: F401  fixtures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = np.iinfo(np.int64).max


def brute(rows, units, window):
    """For each row in order of ids the units and which are removed."""
    seen, out = {}, []
    rows = [(LAST if i is None else i, units(t)) for i, t in rows]
    for i, u in rows:
        for s in range(len(u) - window + 1):
            w = tuple(u[s:s + window])
            seen[w] = min(seen.get(w, LAST), i)
    for i, u in rows:
        gone = [False] * len(u)
        for s in range(len(u) - window + 1):
            if seen[tuple(u[s:s + window])] < i:
                gone[s:s + window] = [True] * window
        out.append((i, u, gone))
    return out


def words(t):
    return WORD.findall(t or "")


def raw(t):
    return (t or "").encode()


def key(rows):
    return sorted(rows, key=repr)


def test_phrases_equal_brute_force(docs, docs_rows):
    got = [(LAST if r.id is None else r.id, r.n_words, r.n_removed, r.kept) for r in phrase_dedup.remove_repeats(docs).collect()]
    want = [(i, len(u), sum(g), " ".join(w for w, x in zip(u, g) if not x)) for i, u, g in brute(docs_rows, words, 50)]
    assert key(got) == key(want) and sum(r[2] for r in want) > 200


def test_bytes_equal_brute_force(docs, docs_rows):
    got = [(LAST if r.id is None else r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()]
    want = [(i, len(u), sum(g), sum(x and not (k and g[k - 1]) for k, x in enumerate(g)), bytes(b for b, x in zip(u, g) if not x)) for i, u, g in brute(docs_rows, raw, 50)]
    assert key(got) == key(want) and sum(r[2] for r in want) > 1000


def test_other_window_lengths(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = key((r.id, r.kept) for r in phrase_dedup.remove_repeats(df, window=9, phrase=3).collect())
    assert got == key((i, " ".join(w for w, x in zip(u, g) if not x)) for i, u, g in brute(rows, words, 9))
    got = key((r.id, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, window=12, phrase=4).collect())
    assert got == key((i, bytes(b for b, x in zip(u, g) if not x)) for i, u, g in brute(rows, raw, 12))


def test_empty_tables(no_docs):
    assert phrase_dedup.remove_repeats(no_docs).collect() == [] and suffix_dedup.remove_repeats(no_docs).collect() == []


@pytest.mark.parametrize("names", [0, 2048])
def test_suffix_array_and_prefixes(monkeypatch, names):
    monkeypatch.setattr(suffix_dedup, "MAX_BUCKETS", names)
    rng = random.Random(names)
    for _ in range(400):
        k = rng.choice([1, 2, 3, 6])
        x = [rng.randint(1, k) for _ in range(rng.randint(1, 60))] + [0]
        order = suffix_dedup.suffix_array(np.array(x), k + 1)
        assert order.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        shared = suffix_dedup.permuted_prefixes(np.array(x, np.uint8), order, 50)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            n = 0
            while n < 50 and max(a, b) + n < len(x) and x[a + n] == x[b + n]:
                n += 1
            assert shared[b] == n


def test_sliding_argmin_takes_the_first_of_equals():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 5, 200).astype(np.uint64) << np.uint64(40)
    assert repeats.sliding_argmin(x, 7).tolist() == [i + int(np.argmin(x[i:i + 7])) for i in range(194)]


def test_contexts_of_a_hot_anchor_part(spark, monkeypatch):
    """A phrase in ever different surroundings: no shard gets all of its contexts, and the result stays exact."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common, tails = text(45), [text(12) for _ in range(6)]
    rows = [(i, text(60) + common + rng.choice(tails) + text(60)) for i in range(300)] + [(None, text(9) + common + tails[0]), (1, common + tails[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    most = []
    for hot in (3_000, 40):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        groups, exchange = [], suffix_dedup.by_range

        def spied(sent, decide):
            for r in sent.collect():
                groups.extend(repeats.unpack(bytes(r.blob))["anchor"].tolist())
            return exchange(sent, decide)

        monkeypatch.setattr(suffix_dedup, "by_range", spied)
        got = [(LAST if r.id is None else r.id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect()]
        monkeypatch.setattr(suffix_dedup, "by_range", exchange)
        want = [(i, len(u), sum(g), bytes(b for b, x in zip(u, g) if not x)) for i, u, g in brute(rows, raw, 50)]
        assert key(got) == key(want) and sum(r[2] for r in want) > 10_000
        most.append(max((groups.count(a) for a in set(groups)), default=0))
    assert most[0] > 200 and most[1] <= 40


@pytest.mark.parametrize("length, k", [(50, 20), (50, 8)])
def test_anchors_are_dealt_evenly(length, k):
    units = repeats.mix(np.random.default_rng(3).integers(1, 1 << 40, 200_000).astype(np.uint64))
    hashes = np.unique(repeats.Runs(units, np.array([len(units)]), length, k).hash)
    cuts, used = repeats.split_ranges(hashes, 48, 34)
    assert len(used) == 34 and np.diff(cuts).max() < 1.5 * len(hashes) / 34
