"""Near duplicates, mixing and fingerprints."""

import collections
import hashlib
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from barsmith.llm import iblt, mixing, order_minhash
from llm_rows import docs, docs_rows, no_docs, prose  # noqa: F401  fixtures


def in_order(a, b):
    p = [0] * (len(b) + 1)
    for x in a:
        q = [0]
        for j, y in enumerate(b):
            q.append(max(p[j] + (x == y) if x == y else 0, p[j + 1], q[-1]))
        p = q
    return p[-1]


def test_banded_alignment_is_exact_above_the_threshold():
    rng = random.Random(3)
    for _ in range(1500):
        a = [rng.randint(0, rng.choice([3, 60])) for _ in range(rng.randint(1, 40))]
        b = [x for x in a if rng.random() > 0.1]
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.randint(0, 60))
        c = in_order(a, b)
        exact, got = c / (len(a) + len(b) - c), order_minhash.similarity(a, b)
        assert abs(exact - got) < 1e-12 if exact >= 0.8 else got < 0.8


def test_classes_equal_brute_force(docs, docs_rows):
    got = {r.id: (r.class_id, r.rep_id) for r in order_minhash.classes(docs).collect()}
    text = {}
    for i, t in docs_rows:
        if i is not None and (t or "").split():
            text[i] = tuple(t.lower().split())
    ids = sorted({i for i, _ in docs_rows if i is not None})
    cls = {i: i for i in ids}
    grams = {i: [w[k:k + 5] for k in range(len(w) - 4)] or [w] for i, w in text.items()}
    for b in ids:
        for a in ids:
            if a < b and a in text and b in text and order_minhash.similarity(grams[a], grams[b]) >= 0.8:
                cls = {i: (min(cls[a], cls[b]) if c in (cls[a], cls[b]) else c) for i, c in cls.items()}
    assert {i: c for i, (c, _) in got.items()} == cls
    assert got[3] == (1, 1) and got[4] == (1, 4) and got[11] == (1, 1) and got[13] == (12, 12)
    assert {cls[i] for i in (5, 6, 7)} == {5, 6, 7}


def test_a_family_around_a_later_document_and_a_hot_bucket(spark):
    """Copies of a base differ more from each other than from the base; unrelated texts share a long line."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(6):
            w[rng.randrange(400)] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    rows.append((60, " ".join(base)))
    line = [f"line{k}" for k in range(20)]
    rows += [(100 + i, " ".join(line + [f"y{i}-{k}" for k in range(12)])) for i in range(80)]
    got = {r.id: r.class_id for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(61)} == {0}
    assert all(got[100 + i] == 100 + i for i in range(80))


@pytest.mark.parametrize("block", [16, 512])
def test_pairs_that_share_only_a_large_bucket(spark, monkeypatch, block):
    """With one band no pair shares a second one; near copies in a bucket of more than SMALL members are linked all the same."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    line = [f"line{k}" for k in range(50)]
    rows = []
    for i in range(120):
        own = [f"y{i}-{k}" for k in range(12)]
        rows += [(2 * i, " ".join(line + own)), (2 * i + 1, " ".join(line + own[:-1] + ["end"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = {r.id: r["keys"][0] for r in order_minhash.sketch(df, "doc_id", "text", 1).collect()}
    hot = collections.Counter(key.values()).most_common(1)[0]
    assert hot[1] > 2 * order_minhash.SMALL
    got = {r.id: r.class_id for r in order_minhash.classes(df, bands=1).collect()}
    pairs = [i for i in range(0, 240, 2) if key[i] == key[i + 1]]
    assert sum(key[i] == hot[0] for i in pairs) > 20
    assert got == {i: i - 1 if i % 2 and i - 1 in pairs else i for i in range(240)}


def test_texts_are_not_shuffled_to_be_read_again(spark, monkeypatch, capsys):
    """Neither few nor many wanted ids move a text; those that the bitmap lets through by chance are dropped, none is lost."""
    rows = [(i, f"text {i} " + "word " * 20) for i in range(3000)] + [(5, "another text"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = spark.range(0, 3500, 5).toDF("id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = order_minhash.sequences(df, "doc_id", "text", wanted)
        got.explain("formatted")
        moved = [x.split("\n\n")[0] for x in re.findall(r"\(\d+\) Exchange.*?(?=\n\(\d+\)|\Z)", capsys.readouterr().out, re.S)]
        assert moved and not any("text#" in x for x in moved)
        assert sorted(r.id for r in got.collect()) == list(range(0, 3000, 5))
        texts = df.withColumnRenamed("doc_id", "id")
        assert 601 <= order_minhash.likely(texts, wanted).count() < 800
        monkeypatch.setattr(order_minhash, "ROW_BITS", 64)
        monkeypatch.setattr(order_minhash, "MOST_BITS", 256)
        assert order_minhash.likely(texts, wanted).count() > 2000
        assert sorted(r.id for r in order_minhash.sequences(df, "doc_id", "text", wanted).collect()) == list(range(0, 3000, 5))
        assert order_minhash.sequences(df, "doc_id", "text", wanted.limit(0)).collect() == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_documents(no_docs):
    assert order_minhash.classes(no_docs).collect() == [] and mixing.plan(no_docs).collect() == [] and iblt.versions(no_docs).collect() == []


def mixed_rows():
    rng = random.Random(4)
    rows = [(i, None if i % 50 == 7 else " ".join("w" * rng.randint(1, 30) for _ in range(rng.randint(0, 40))), "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    return rows + [(1000, "a b c", None), (1001, "", "empty"), (1001, "", "empty"), (None, "a b", "s1"), rows[5]]


def test_an_id_with_two_texts_is_one_of_them(spark):
    """Copies, near copies and an id that holds both texts: no link of either text is mixed with the other's, and 3 and 5 stay linked."""
    rng = random.Random(12)
    a, b = ("aa " + prose(rng, 200), "zz " + prose(rng, 200))
    near = b.split()
    near[100] = "changed"
    for first in ((1, a), (1, b)):
        rows = [first, (1, b if first[1] == a else a), (2, a), (3, b), (5, " ".join(near))]
        got = {r.id: r.class_id for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got[3] == got[5] != got[2]
        assert got[1] in (got[2], got[3])


def test_mixing_equals_its_sql_and_keeps_the_budget(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan(df)
    got = sorted((tuple(r) for r in plan.select("id", "source", "n_tokens", "copies").collect()), key=repr)
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    assert got == sorted(con.execute(mixing.oracle()).fetchall(), key=repr)
    total = sum(r[2] for r in got)
    assert 0.9 * total < sum(r[2] * r[3] for r in got) <= total
    plain, mixed = collections.Counter(), collections.Counter()
    for _, s, n, k in got:
        plain[s] += n
        mixed[s] += n * k

    def entropy(by):
        return -sum(x / sum(by.values()) * math.log(x / sum(by.values())) for x in by.values() if x)

    assert entropy(mixed) > entropy(plain) and max(k for *_, n, k in got if n) <= 4
    real = mixing.realise(df, plan)
    copies = collections.Counter((r.doc_id, r.source) for r in real.collect())
    times = collections.Counter((r[0], r[2]) for r in rows)
    assert copies == {k: n for k, n in {(r[0], r[1]): r[3] * times[r[0], r[1]] for r in got}.items() if n}
    assert set(real.columns) == {"doc_id", "text", "source", "mix_block", "mix_order"}


def test_each_block_holds_the_weights(spark):
    """Of a source that is cut, of one taken more than once and of one between, every block has its share of tokens."""
    rng = random.Random(10)
    rows = [(i, " ".join("w" * rng.randint(20, 30)), "a" if i % 20 < 15 else "b" if i % 20 < 19 else "c") for i in range(12_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan(df)
    weight = {r.source: r.weight for r in plan.select("source", "weight").distinct().collect()}
    assert len({r.copies for r in plan.select("copies").distinct().collect()}) > 2
    size = {i: len(t.split()) for i, t, _ in rows}
    held = collections.defaultdict(collections.Counter)
    for r in mixing.realise(df.drop("text"), plan, blocks=8, pass_col="pass").collect():
        held[r.mix_block][r.source] += size[r.doc_id]
    assert sorted(held) == list(range(8))
    for by in held.values():
        assert all(abs(by[s] / sum(by.values()) - w) < 0.04 for s, w in weight.items())


def test_repetition_limit_wins(spark):
    sources = spark.createDataFrame([("a", 9900, 0.99), ("b", 100, 0.01)], "source string, n_tokens long, share double")
    alpha = mixing.bisect_alpha(sources, 1.0, 1.0, 5.0)
    top = 0.01 ** alpha / (0.01 ** alpha + 0.99 ** alpha) / 0.01
    assert 4.99 < top <= 5.0 + 1e-6
    assert mixing.bisect_alpha(sources, 1.0, None, None) == 1.0 and mixing.bisect_alpha(sources, 1.0, 1.0, None) < 1e-6


PARA = re.compile(iblt.PARAGRAPH)


def jaccard(a, b):
    a, b = collections.Counter(PARA.findall(a)), collections.Counter(PARA.findall(b))
    u = sum((a | b).values())
    return sum((a & b).values()) / u if u else 1.0


def peeled(text):
    """The digests that a fingerprint holds, read back from its text (for few paragraphs)."""
    n, cells = text.split(":")
    cells = [[int(x, 16) for x in c.split(".")] if c else [0, 0, 0] for c in cells.split(",")]
    assert len(cells) == 24 and sum(c[0] for c in cells) == 3 * int(n)
    found = set()
    while any(c[0] == 1 for c in cells):
        k, check = next((c[1], c[2]) for c in cells if c[0] == 1)
        found.add(k)
        held = [c for c in cells if c[0] and (c[0] > 1 or c[1] == k)]
        for row in range(3):
            at = [c for c in held if c in cells[8 * row:8 * row + 8] and c[0] == 1 and c[1] == k]
            for c in at:
                c[:] = [0, 0, 0]
    return found


def test_sketches_of_many_paragraphs_are_linear(spark):
    """20,000 paragraphs against 20,000 others, of which half are the same."""
    import time
    rng = random.Random(9)
    a = [rng.getrandbits(63) for _ in range(20_000)]
    b = a[:10_000] + [rng.getrandbits(63) for _ in range(10_000)]
    df = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    start = time.time()
    assert df.select(iblt.likeness("a", "b")).first()[0] == 10_000 / 30_000
    assert time.time() - start < 60


@pytest.mark.parametrize("stretch", [2, 2048])
def test_fingerprints_equal_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(iblt, "STRETCH", stretch)
    monkeypatch.setattr(iblt, "CELLS", 4)
    rng = random.Random(6)
    lines = [" ".join(rng.choice(["ab", "cd", "éé", "😀"]) for _ in range(rng.randint(1, 60))) + "." for _ in range(30)]
    rows = [(i * i * (-1) ** i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    rows += [(None, "z\ny"), (None, None), (3000, None), (3001, ""), (3002, "one line only"), (3002, "one line only"), (3003, "\n".join(f"l{k}" for k in range(400)))]
    got = sorted((tuple(r) for r in iblt.compare(iblt.versions(spark.createDataFrame(rows, "doc_id long, text string"))).collect()), key=repr)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), jaccard(t, e), jaccard(t, n)))
    assert [(r[0], r[1], r[2], round(r[5], 9), round(r[6], 9)) for r in got] == [(*w[:3], round(w[3], 9), round(w[4], 9)) for w in sorted(want, key=repr)]
    prints = {r[0]: (r[3], r[4]) for r in got}
    assert peeled(prints[3001][0]) == set() and len(peeled(prints[3002][0])) == 1
    assert prints[3000][0] == prints[3001][0] and len({r[3] for r in got}) == len({t for _, t in order})


def test_peeling_takes_exactly_the_difference(spark):
    rng = random.Random(8)
    rows = []
    for n in (0, 1, 5, 40, 300):
        a = [rng.getrandbits(63) for _ in range(n)]
        rows.append((a, a[: n // 2] + [rng.getrandbits(63) for _ in range(n // 3)]))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    got = [r[0] for r in df.select(F.expr(iblt.difference_sql("a", "b"))).collect()]
    assert got == [len(set(a) ^ set(b)) for a, b in rows]
