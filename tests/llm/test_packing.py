"""Packing: ids as the library gives them, every piece placed once and without holes, as few sequences as sequential best fit."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barsmith.llm import packing
from barsmith.llm.queries import op13_packing
from conftest import SF_SMALL
from llm_rows import docs, docs_rows, no_docs  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def best_fit(lengths, capacity):
    """Number of sequences that best fit, largest first, one piece after the other, needs."""
    gaps, n = Counter(), 0
    for size in sorted(lengths, reverse=True):
        gap = min((g for g in gaps if g >= size), default=None)
        if gap is None:
            gap, n = capacity, n + 1
        else:
            gaps[gap] -= 1
            gaps += Counter()
        gaps[gap - size] += 1
    return n


def test_words_are_encoded_as_the_library_does(plain):
    rng = random.Random(1)
    letters = "aZ'sStTdDmM0159.,;:!?\"()-_<>|@#ÀÉéêëœŒßŸıİſ×÷ĲŉÅñ \t\n\x0b\x0c\r\x85 　日本語😀éH̱ΣσςΑÅfi½²\x00\x1c"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["", " ", "a" * 3000, "'re're I'LL we'Ve", "<|endoftext|> x<|startoftext|>", "İstanbul"]
    coder = packing.Encoder(PATH)
    assert coder.by_word
    assert [i.tolist() for i in coder.of_texts(pa.array(texts))] == plain(texts)
    coder.by_word = False
    assert [i.tolist() for i in coder.of_texts(pa.array(texts))] == plain(texts)


def check(rows, texts, plain, capacity):
    """``rows``: (doc, piece, start, length, crc, sequence, offset) of ``texts`` by doc."""
    want = {}
    for doc, ids in zip(texts, plain([t or "" for t in texts.values()])):
        ids = np.array([*ids, 1], dtype="<u4")
        for k, start in enumerate(range(0, len(ids), capacity)):
            want[doc, k] = (start, len(ids[start:start + capacity]), zlib.crc32(ids[start:start + capacity].tobytes()))
    assert {(r[0], r[1]): tuple(r[2:5]) for r in rows} == want and len(rows) == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), [n for _, n, _ in want.values()]


def test_query_packs_every_document(spark, plain):
    got = op13_packing(spark, SF_SMALL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = [tuple(r) for r in got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    n, lengths = check(rows, texts, plain, 4096)
    assert n <= best_fit(lengths, 4096) * 1.02 + 1


def test_defined_cases(spark, plain, docs, docs_rows, no_docs):
    got = packing.pack(packing.pieces(docs, PATH, capacity=50), capacity=50).collect()
    whole = [len(i) + 1 for i in plain([t or "" for _, t in docs_rows])]
    assert Counter((r.id) for r in got if r.piece == 0) == Counter(i for i, _ in docs_rows)
    assert sum(r.length for r in got) == sum(whole) and max(r.length for r in got) == 50
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 50 and len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert packing.pack(packing.pieces(no_docs, PATH)).count() == 0


def test_superstep_over_ranges_equals_one_sweep(spark):
    rng = random.Random(2)
    items = [(s, 0, rng.randint(1, 40)) for s in rng.sample(range(1, 200), 60)]
    gaps, at = [], 0
    for g in rng.sample(range(1, 200), 50):
        n = rng.randint(1, 30)
        gaps.append((g, at, n))
        at += n
    one, many = packing.sweep(items, gaps), packing.superstep(spark, items, gaps, ranges=4)
    pieces = lambda matches: Counter((m[0], m[5]) for m in matches for _ in range(m[2]))
    rows = lambda runs: Counter((r[0], k) for r in runs for k in range(r[1], r[1] + r[2]))
    assert pieces(one[0]) == pieces(many[0])
    assert all(rows(a) == rows(b) for a, b in zip(one[1:], many[1:]))


@pytest.mark.parametrize("seed", range(6))
def test_schedule_equals_best_fit_within_two_per_cent(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 100, 1000])
    lengths = [min(capacity, 1 + int(rng.expovariate(rng.choice([0.3, 3.0]) / capacity * 4))) for _ in range(4000)] + [capacity // 2] * 3000
    matches, opened = packing.schedule(Counter(lengths), capacity, packing.sweep)
    assert opened <= best_fit(lengths, capacity) * 1.02 + 1
    fill = Counter()
    ranks = Counter()
    for size, first, n, take, seq, gap in matches:
        ranks[size] += n
        for i in range(n):
            assert fill[seq + i // take] == capacity - gap + i % take * size
            fill[seq + i // take] += size
    assert ranks == Counter(lengths) and max(fill.values()) <= capacity and len(fill) <= opened


def test_one_length_is_ranked_over_many_partitions(spark):
    rows = spark.range(0, 3000, 1, 7).selectExpr("cast(null as long) id", "case when id % 3 = 0 then 5L else 2L + id % 2 end length")
    got = packing.ranked(rows, "length").collect()
    by = {}
    for r in got:
        by.setdefault(r.length, []).append(r._rank)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(got) == 3000
