"""Corpus pipeline: toxic documents and near copies go, repeated passages are cut, sources are mixed, texts become ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents.  All but the last return
the columns of ``documents``; rows with a null id pass the stages that look
documents up by their id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import bpe, mixing, order_minhash, phrase_dedup, toxicity
from barsmith.llm.common import fold, materialise, read

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECT = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under ``REJECT``; labels of fold 1 are not learned from."""
    docs = docs.select(*COLUMNS)
    machine = toxicity.fit(docs, read(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1))
    return toxicity.score(docs, machine, out_col="toxicity_score").where(F.col("toxicity_score") < REJECT).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of least id."""
    docs = docs.select(*COLUMNS)
    stay = order_minhash.classes(docs).where("id = class_id").select(F.col("id").alias("doc_id"))
    kept = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null")).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word passages that documents of smaller id hold; untouched texts stay as they are."""
    docs = docs.select(*COLUMNS)
    cut = (phrase_dedup.remove_repeats(docs).where("n_removed > 0 and id is not null")
           .select(F.col("id").alias("doc_id"), "kept"))
    return (docs.join(cut, "doc_id", "left").withColumn("text", F.coalesce("kept", "text"))
            .withColumn("n_chars", F.when(F.col("kept").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the tempered weights of their sources ask for, with a budget of all tokens; written by block and order."""
    docs = docs.select(*COLUMNS)
    return mixing.in_order(mixing.realise(docs, mixing.plan(docs))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    import public_tokenizers
    got = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return got.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("repeated passages", cut_repeats),
    ("source mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: SQL cannot express the stages; they are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = materialise(docs, f"stage-{k}")
    return docs
