"""Language identification, toxicity and nearest neighbours."""

import random

import numpy as np
import pytest

from barsmith.llm import collision_ann, lang_id, toxicity


def labelled(spark, n=240):
    rng = random.Random(1)
    alphabets = {"xx": ["ba", "bo", "ki", "lu"], "yy": ["tsch", "ung", "eit", "oe"], "zz": ["éa", "ñi", "ou", "ça"]}
    rows = [(i, " ".join("".join(rng.choice(alphabets[la]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 60))), la)
            for i, la in ((i, rng.choice(list(alphabets))) for i in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_are_told_apart_and_others_rejected(spark):
    df = labelled(spark)
    model = lang_id.fit(df)
    got = lang_id.predict(df.withColumnRenamed("lang", "score"), model).collect()
    assert len(got) == 240 and set(got[0].asDict()) == {"doc_id", "lang_pred", "score", "accepted", "entropy"}
    truth = {r.doc_id: r.lang for r in df.collect()}
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 238 and all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 --"), (4, "wxyz qqq jjj vvv " * 30), (5, "bakilu " * 20000)], "doc_id long, text string")
    by = {r.doc_id: r for r in lang_id.predict(odd, model).collect()}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and not by[i].accepted for i in (1, 2, 3))
    assert not by[4].accepted and by[5].lang_pred == "xx"


def test_kneser_ney_probabilities_sum_to_one(spark):
    df = labelled(spark)
    model = lang_id.fit(df)
    letters = sorted({c for r in df.collect() for c in r.text if c != " "})
    for context in ("", "b", "ba", "sch", "kib"):
        sums = sum(_p(model, context, c) for c in [*letters, lang_id.END])
        assert np.all(sums < 1 + 1e-5) and np.all(sums > 0.9)          # the rest is for letters never seen


def _p(model, context, c):
    """Probability of a character (or the end) after the beginning of a word."""
    if c == lang_id.END:
        return np.exp(model.score_words([context])[0] - _prefix(model, context)) if context else np.zeros(len(model.langs))
    return np.exp(_prefix(model, context + c) - _prefix(model, context))


def _prefix(model, word):
    """Log probability of the characters of a word without its end."""
    chars, place = lang_id._chars([word])
    total, p, last = np.zeros(len(model.langs)), None, None
    for k, h in enumerate(lang_id._grams(chars, model.order), 1):
        line = model.find(h)
        if k == 1:
            p = model.prob[line] + model.base
        else:
            ctx = np.concatenate([[len(model.keys)], last[:-1]])
            p = np.where((place >= k - 1)[:, None], model.prob[line] + model.back[ctx] * p, p)
        last = line
    return total + np.log(p)[1:-1].sum(0)


def test_no_languages(spark):
    df = labelled(spark, 6)
    model = lang_id.fit(df.where("lang is null"))
    assert {r.lang_pred for r in lang_id.predict(df, model).collect()} == {"und"}
    assert lang_id.predict(df.limit(0), model).collect() == []


def test_toxicity_learns_words_and_pairs(spark):
    rng = random.Random(2)
    neutral = [f"n{k}" for k in range(60)]

    def text(i):
        w = [rng.choice(neutral) for _ in range(rng.randint(3, 80))]
        kind = i % 4
        if kind == 0:
            w += ["scum"]
        if kind == 1:                       # only the pair is toxic
            w += ["foo", "bar"]
        if kind == 2:
            w += [rng.choice(["foo", "bar"])]
        rng.shuffle(w)
        return " ".join(w), int(kind in (0, 1))

    rows = [(i, *text(i)) for i in range(900)]
    docs = spark.createDataFrame([(i, t, 0.1) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(5000, 1, 1), (0, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    machine = toxicity.fit(docs, labels)
    fresh = [(i, *text(i)) for i in range(10_000, 10_400)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame([(i, t) for i, t, _ in fresh], "doc_id long, text string"), machine).collect()}
    assert sum((got[i] >= 0.7) == bool(y) for i, _, y in fresh) >= 390
    odd = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "scum " * 50_000, 0.5), (4, "unknownword", 0.5)], "doc_id long, text string, score double")
    by = {r.doc_id: r.score for r in toxicity.score(odd, machine).collect()}
    assert by[1] == by[2] and by[3] >= 0.7 and all(0 <= s <= 1 for s in by.values())


def test_toxicity_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for labels, want in (([], 0.0), ([(1, 1), (2, 1)], 1.0)):
        machine = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert all(abs(r.score - want) < 1e-6 for r in toxicity.score(docs, machine).collect())
    assert toxicity.score(docs.limit(0), machine).collect() == []


@pytest.mark.parametrize("hot", [False, True])
def test_neighbours_against_brute_force(spark, hot):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    if hot:
        x[::3] = x[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [1.0] * 15, 1), (904, [1.0, None] + [0.0] * 14, 1), (None, [1.0] * 16, 1), rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {}
    for r in collision_ann.search(df, df.vec_id % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    s = x.astype(float)
    hits = 0
    for q in range(0, 900, 20):
        inner = (s * s[q]).sum(1)
        want = sorted((-round(inner[i], 12), i) for i in range(900) if i != q)[:20]
        own = sorted(got[q])
        assert [r for r, *_ in own] == list(range(1, 21))
        assert all(abs(inner[i] - v) < 1e-9 for _, i, v in own)
        hits += len({i for _, i in want} & {i for _, i, _ in own})
    assert hits >= 0.95 * 45 * 20 and set(got) == set(range(0, 900, 20))


@pytest.mark.parametrize("clusters", [0, 50])
def test_few_vectors_are_verified(clusters):
    """Without clusters most vectors must not be verified either, and nearly all of the nearest are."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(10_000, 64))
    if clusters:
        x = x * 0.5 + rng.normal(size=(clusters, 64))[rng.integers(0, clusters, len(x))]
    x *= rng.uniform(0.9, 1.0, (len(x), 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    queries = x[::200]
    index = collision_ann.ShardIndex(x, np.linalg.norm(x, axis=1).max())
    verified = hits = 0
    for q, (lines, scores) in zip(queries, index.search(queries, 21)):
        inner = (x * q).sum(1)
        assert len(set(lines.tolist())) == len(lines) and np.abs(inner[lines] - scores).max() < 1e-12
        verified += len(lines)
        hits += len(set(np.argsort(-inner)[:21].tolist()) & set(lines.tolist()))
    assert verified < 0.25 * len(queries) * len(x) and hits >= 0.98 * 21 * len(queries)


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in collision_ann.search(df, df.vec_id == 0).collect())
    assert got == [(0, 1, 2, 0.0), (0, 2, 1, -1.0)]
    assert collision_ann.search(df.limit(0), df.vec_id == 0).collect() == []
