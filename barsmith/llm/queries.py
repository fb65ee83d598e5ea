"""The numbered queries over whole tables and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import bpe, collision_ann, conversation_repair, iblt, lang_id, mixing, order_minhash, packing, phrase_dedup, suffix_dedup, toxicity, warc, whitening
from barsmith.llm.common import fold, read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney language identification of every document; learned from the folds that are not 0."""
    docs = read(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(fold("doc_id", 5) != 0))
    got = lang_id.predict(docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text"), model)
    return got.select("doc_id", "held_out", "lang_pred", "score", "accepted", "entropy")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factorization-machine toxicity of every document; learned from the labels of folds that are not 1."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels.where(fold("doc_id", 3) != 1))
    got = toxicity.score(docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text"), machine)
    return got.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found by inner product for every vector whose id is divisible by 20."""
    return collision_ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that documents of smaller id hold."""
    got = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to Zstandard WARC archives and read back from them."""
    got = warc.read_archives(warc.write_archives(read(spark, sf_dir, "pages")))
    return got.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, and the links of its member."""
    got = order_minhash.classes(read(spark, sf_dir, "documents"))
    return got.withColumnRenamed("id", "doc_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken when its source's share is tempered and the budget is all tokens."""
    got = mixing.plan(read(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "source", "n_tokens", "copies")


def op6_mixing_realised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document with its pass, its block, and its place in the order of the block."""
    docs = read(spark, sf_dir, "documents")
    got = mixing.realise(docs.select("doc_id", "source"), mixing.plan(docs), pass_col="pass")
    return got.select("doc_id", "source", "pass", "mix_block", "mix_order")


def op7_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, and how alike they and the next document's are."""
    got = iblt.compare(iblt.versions(read(spark, sf_dir, "documents")))
    return got.withColumnRenamed("id", "doc_id")


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word passages that documents of smaller id hold."""
    got = phrase_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str, rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """Byte-level BPE ids of every document and the digest of what they decode to."""
    import public_tokenizers
    got = bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken"),
                     pattern or public_tokenizers.PATTERN, packed=True, round_trip=True)
    return got.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first eight whitened components of all vectors."""
    vectors = read(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    got = whitening.whiten(vectors, model, k=8)
    return got.select(F.col("id").alias("vec_id"), "component", F.lit(model.n).cast("long").alias("n"), F.col("deviation").cast("long").alias("deviation"),
                      "whitened", "explained", F.lit(whitening.identity_error(vectors, model, k=8)).alias("identity_error"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the repaired text of every conversation, damaged by the hash of its turns."""
    chats = read(spark, sf_dir, "conversations")
    rows = conversation_repair.damaged(chats)
    lists = conversation_repair.audits(rows)
    hashes = conversation_repair.digests(conversation_repair.repaired(rows, lists))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    out = chats.select("conv_id").distinct().join(lists, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    return out.join(hashes, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, cut and packed into sequences of 4096."""
    import public_tokenizers
    got = packing.pack(packing.pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096), capacity=4096)
    return got.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_collision_ann": op2_collision_ann,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_warc": op4_warc,
        "op5_order_minhash": op5_order_minhash,
        "op6_mixing": op6_mixing,
        "op7_iblt_fingerprints": op7_iblt_fingerprints,
        "op8_phrase_dedup": op8_phrase_dedup,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_toxicity": op10_toxicity,
        "op11_whitening": op11_whitening,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_packing": op13_packing,
    }


#: Base32 of a SHA-1 in hexadecimal: five bits at a time, out of three digits.
_BASE32 = """list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + (((('0x' || substr(x || '00', (1 + 5 * i // 4)::BIGINT, 3))::INTEGER >> (7 - 5 * i % 4)::INTEGER) & 31))::BIGINT, 1)), 'string_agg', '')"""

WARC_SQL = f"""
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS x,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d"""


PHRASE_SQL = f"""
WITH d AS (SELECT doc_id, w, len(w) AS n FROM (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{mixing.TOKEN}') AS w FROM documents)),
unit AS (SELECT doc_id, w, n, unnest(range(1, n + 1)) AS i FROM d),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM unit WHERE i + 49 <= n),
low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM win JOIN low USING (k), range(0, 50) r(j) WHERE m < doc_id),
s AS (SELECT u.doc_id, count(g.i) AS r, string_agg(u.w[u.i], ' ' ORDER BY u.i) FILTER (g.i IS NULL) AS kept
      FROM unit u LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.i = u.i GROUP BY u.doc_id)
SELECT d.doc_id, n::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": WARC_SQL,
        "op6_mixing": mixing.oracle(),
        "op8_phrase_dedup": PHRASE_SQL,
    }


def more_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Further results of a numbered operator, registered beside it."""
    return {"op6_mixing_realised": op6_mixing_realised}


def more_sql() -> dict[str, str]:
    return {"op6_mixing_realised": mixing.realised_oracle()}
