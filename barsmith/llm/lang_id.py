"""Language identification with interpolated Kneser-Ney character models.

A text is read as its case-folded letter runs.  Every language gets a character
model of ``order`` characters over words with a start and an end mark:

    P_k(c | h) = max(a(hc) - D_k, 0) / a(h.) + D_k * N(h.) / a(h.) * P_{k-1}(c | h')

a() is the count for the highest order and for n-grams that begin with the start
mark, and the number of different characters seen to the left for all others.
Counts, continuation counts, discounts and sums are DataFrame aggregations over
a bounded sample of labelled rows.  The model is one sorted array of n-gram
hashes with a column of discounted probabilities and of back-off weights for
each language.  The language with the lowest cross-entropy per character wins.

Scores are calibrated on a fifth of the sample that the counts do not see: a
temperature turns entropies into probabilities, and each language gets a limit
for its entropy, above which ``accepted`` is false.

Defined cases: a null text or one without letters is ``und`` with score 0 and
not accepted; without any learned language every text is; ties go to the smaller
language name; repeated rows are predicted each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import append, first_by_hash, materialise, plus, prepare, slices

LETTERS = re.compile(r"[^\W\d_]+")
START, END = "\x02", "\x03"
UNKNOWN = "und"
#: Words whose scores a task remembers at a time.
MEMO = 150_000


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def _chars(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the marked words in a row, and each one's place in its word."""
    joined = START + (END + START).join(words) + END
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.flatnonzero(c == ord(START))
    lengths = np.diff(np.append(begins, len(c)))
    return c.astype(np.uint64), np.arange(len(c)) - np.repeat(begins, lengths)


def _grams(c: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Hash of the k characters that end at each place, for k = 1, 2 ... order."""
    h = np.zeros(len(c), np.uint64)
    for k in range(1, order + 1):
        before = np.concatenate([[np.uint64(0)], h[:-1]])
        h = _mix(before * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(k << 32))
        yield h


@dataclass
class LanguageModel:
    langs: list[str]
    order: int
    keys: np.ndarray            # sorted hashes of n-grams
    prob: np.ndarray            # discounted probability, a column for each language
    back: np.ndarray            # back-off weight of the n-gram as a context (1: never seen as one)
    base: np.ndarray            # what the empty context leaves to characters never seen
    temperature: float = 20.0
    limit: np.ndarray | None = None

    def find(self, h: np.ndarray) -> np.ndarray:
        """Line of each hash, the last line (of zeros) where it is missing."""
        at = np.searchsorted(self.keys, h)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == h, at, len(self.keys)) if len(self.keys) else np.zeros(len(h), int)

    def score_words(self, words: list[str]) -> np.ndarray:
        """Sum of log probabilities of each word and its end, a column for each language."""
        if not words:
            return np.zeros((0, len(self.langs)))
        c, place = _chars(words)
        p = last = None
        for k, h in enumerate(_grams(c, self.order), 1):
            line = self.find(h)
            if k == 1:
                p = self.prob[line] + self.base
            else:
                context = np.concatenate([[len(self.keys)], last[:-1]])
                deep = place >= k - 1
                p = np.where(deep[:, None], self.prob[line] + self.back[context] * p, p)
            last = line
        logs = np.log(np.maximum(p, 1e-12))
        begins = np.flatnonzero(place == 0)
        logs[begins] = 0                                  # the start mark is given
        return np.add.reduceat(logs, begins)

    def entropies(self, texts: list[str | None], memo: dict[str, int], table: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and its number of characters."""
        split = [words_of(t) for t in texts]
        fresh = {w: None for ws in split for w in ws if w not in memo}
        if fresh:
            if len(memo) > MEMO:
                memo.clear()
                table.clear()
                fresh = {w: None for ws in split for w in ws}
            new = list(fresh)
            for at in range(0, len(new), 20_000):          # bounds the arrays for each character
                part = new[at:at + 20_000]
                at0 = len(memo)
                memo.update(zip(part, range(at0, at0 + len(part))))
                sums = self.score_words(part)
                table.append(np.column_stack([sums, [len(w) + 1 for w in part]]))
        whole = np.concatenate(table) if len(table) > 1 else (table[0] if table else np.zeros((1, len(self.langs) + 1)))
        table[:] = [whole]
        sizes = np.array([len(ws) for ws in split])
        flat = np.fromiter((memo[w] for ws in split for w in ws), np.int64, int(sizes.sum()))
        out = np.zeros((len(texts), whole.shape[1]))
        full = np.flatnonzero(sizes)
        if len(full):
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            out[full] = np.add.reduceat(whole[flat], starts)
        n = out[:, -1]
        return -out[:, :-1] / np.maximum(n, 1)[:, None], n

    def decide(self, entropy: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its calibrated probability, whether the entropy is usual for it."""
        best = entropy.argmin(1)
        z = np.exp(-self.temperature * (entropy - entropy.min(1, keepdims=True)))
        p = 1 / z.sum(1)
        usual = entropy[np.arange(len(best)), best] <= self.limit[best]
        return best, np.where(n > 0, p, 0.0), usual & (n > 0)


def count_grams(words: DataFrame, order: int) -> DataFrame:
    """(lang, gram, k, prob, back) from (lang, word, n): the discounted probability of the gram's last
    character and the back-off weight of the gram as a context."""
    marked = words.withColumn("s", F.concat(F.lit(START), "word", F.lit(END)))
    k = F.explode(F.sequence(F.lit(1), F.least(F.col("end"), F.lit(order)))).alias("k")
    grams = (marked.select("lang", "s", "n", F.explode(F.sequence(F.lit(2), F.length("s"))).alias("end"))
             .select("lang", "s", "n", "end", k)
             .select("lang", "n", "k", F.expr("substring(s, end - k + 1, k)").alias("gram"))
             .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")))
    grams = materialise(grams, "grams")
    left = (grams.where(F.col("k") > 1)
            .select("lang", (F.col("k") - 1).alias("k"), F.expr("substring(gram, 2)").alias("gram"))
            .groupBy("lang", "k", "gram").agg(F.count("*").alias("kinds")))
    count = F.when((F.col("k") == order) | F.col("gram").startswith(START), F.col("n")).otherwise(F.coalesce("kinds", "n"))
    adjusted = grams.join(left, ["lang", "k", "gram"], "left").select("lang", "k", "gram", count.alias("a"))
    adjusted = materialise(adjusted, "adjusted")
    discount = (adjusted.groupBy("lang", "k")
                .agg(F.count_if(F.col("a") == 1).alias("n1"), F.count_if(F.col("a") == 2).alias("n2"))
                .select("lang", "k", F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2")))
                        .otherwise(F.lit(0.5)).alias("d")))
    context = F.expr("substring(gram, 1, k - 1)")
    sums = (adjusted.withColumn("gram", context).groupBy("lang", "k", "gram")
            .agg(F.sum("a").alias("total"), F.count("*").alias("kinds")))
    # one line for each language and order: bounded by the languages
    sums = sums.join(F.broadcast(discount), ["lang", "k"]).withColumn("back", F.col("d") * F.col("kinds") / F.col("total"))
    prob = (adjusted.withColumn("context", context)
            .join(sums.select("lang", "k", F.col("gram").alias("context"), "total", "d"), ["lang", "k", "context"])
            .select("lang", "gram", (F.greatest(F.col("a") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("prob"), F.lit(None).cast("double").alias("back")))
    backs = sums.select("lang", "gram", F.lit(None).cast("double").alias("prob"), "back")
    return prob.unionByName(backs).groupBy("lang", "gram").agg(F.max("prob").alias("prob"), F.max("back").alias("back"))


def build_model(rows: DataFrame, langs: list[str], order: int) -> LanguageModel:
    """Sorted hash arrays from the table of ``count_grams`` (bounded by the sample)."""
    got = rows.toPandas()
    col = {lang: i for i, lang in enumerate(langs)}
    at = got["lang"].map(col).to_numpy()
    grams = got["gram"].to_numpy()
    hashes = np.zeros(len(got), np.uint64)
    lengths = np.array([len(g) for g in grams])
    for k in range(1, order + 1):
        pick = np.flatnonzero(lengths == k)
        if len(pick):
            c = np.frombuffer("".join(grams[pick]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            hashes[pick] = list(_grams(c, k))[-1][k - 1::k]
    real = lengths > 0
    keys, line = np.unique(hashes[real], return_inverse=True)
    prob = np.zeros((len(keys) + 1, len(langs)), np.float32)
    back = np.ones((len(keys) + 1, len(langs)), np.float32)
    p, b, lang = got["prob"].to_numpy(float)[real], got["back"].to_numpy(float)[real], at[real]
    has = ~np.isnan(p)
    prob[line[has], lang[has]] = p[has]
    has = ~np.isnan(b)
    back[line[has], lang[has]] = b[has]
    letters = max(2, int((lengths == 1).sum()) + 1)
    base = np.zeros(len(langs), np.float32)
    empty = got[lengths == 0]
    base[empty["lang"].map(col).to_numpy(int)] = empty["back"].to_numpy(float) / letters
    return LanguageModel(langs, order, keys, prob, back, np.maximum(base, 1e-9))


def _entropy_frame(docs: DataFrame, model: LanguageModel, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, memo, table = shared.value, {}, []
        for batch in batches:
            for part in slices(batch, text_col):
                e, n = m.entropies(part.column(text_col).to_pylist(), memo, table)
                yield append(part.drop_columns([text_col]), entropy=pa.array(list(e), pa.list_(pa.float64())), n=pa.array(n, pa.float64()))

    return docs.mapInArrow(run, plus(docs, "entropy array<double>, n double", drop=text_col))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = 4,
        max_docs_per_lang: int = 1_500) -> LanguageModel:
    """Fit on at most ``max_docs_per_lang`` rows of each language, taken by the hash of their id."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).where("id is not null and lang is not null")
    chosen = (first_by_hash(rows, "lang", "id", max_docs_per_lang)
              .select("id", (F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(5)) == 0).alias("calibrate")).distinct())
    texts = (docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
             .where("lang is not null and text is not null").join(F.broadcast(chosen), "id"))
    texts = materialise(texts, "lang-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tally: Counter = Counter()
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    tally.update((lang, w) for w in words_of(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in tally], pa.string()), pa.array([k[1] for k in tally], pa.string()),
                     pa.array(list(tally.values()), pa.int64())], names=["lang", "word", "n"])

    words = (texts.where("not calibrate").select("lang", "text").mapInArrow(count, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    langs = sorted(r[0] for r in texts.select("lang").distinct().collect())
    if not langs:
        return LanguageModel([], order, np.zeros(0, np.uint64), np.zeros((1, 0)), np.ones((1, 0)), np.zeros(0), 1.0, np.zeros(0))
    model = build_model(count_grams(words, order), langs, order)
    held = _entropy_frame(texts.where("calibrate").select("lang", "text"), model, "text").toPandas()
    return calibrate(model, held)


def calibrate(model: LanguageModel, held) -> LanguageModel:
    """Temperature of least loss, and each language's limit of entropy, on rows that the counts did not see."""
    model.limit = np.full(len(model.langs), np.inf)
    held = held[held["n"] > 0]
    if len(held):
        e = np.vstack(held["entropy"].to_numpy())
        y = held["lang"].map({x: i for i, x in enumerate(model.langs)}).to_numpy(int)

        def loss(t: float) -> float:
            z = -t * (e - e.min(1, keepdims=True))
            return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean())

        model.temperature = min((2.0 ** (k / 2) for k in range(0, 15)), key=loss)
        for i in range(len(model.langs)):
            own = np.sort(e[y == i, i])
            if len(own) >= 5:
                model.limit[i] = np.quantile(own, 0.995) + 0.1
    return model


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` without the text, with lang_pred, score, accepted and entropy (of the language chosen), in
    place of columns of these names."""
    spark = docs.sparkSession
    docs = docs.drop("lang_pred", "score", "accepted", "entropy")
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, memo, table = shared.value, {}, []
        names = np.array([*m.langs, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                if m.langs:
                    e, n = m.entropies(texts, memo, table)
                    best, p, usual = m.decide(e, n)
                    low = np.where(n > 0, e.min(1), np.nan)
                    best = np.where(n > 0, best, len(m.langs))
                else:
                    best, p, usual, low = (np.full(len(texts), x) for x in (0, 0.0, False, np.nan))
                yield append(part.drop_columns([text_col]), lang_pred=pa.array(names[best], pa.string()), score=pa.array(p, pa.float64()),
                             accepted=pa.array(usual, pa.bool_()), entropy=pa.array(low, pa.float64()))

    return docs.mapInArrow(run, plus(docs, "lang_pred string, score double, accepted boolean, entropy double", drop=text_col))
