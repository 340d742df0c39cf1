"""A corpus made ready for training: documents in, token ids out.

Every stage takes the documents that the stage before kept and returns those
that it keeps, with the columns of ``documents``; the last one returns their
ids. Between two stages the documents are a Parquet table in the shared
folder, so an executor that is lost costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backdrop.llm import bpe_chunks, decontamination, exact_dedup, near_dedup, tokens, toxicity
from backdrop.llm.common import documents, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5. A NULL or empty text is scored as an empty window."""
    net = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    score = "_toxicity"
    while score in map(str.lower, docs.columns):
        score += "_"
    return toxicity.score_rows(docs, net, score_col=score).where(F.col(score) < 0.5).select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id; NULL and empty texts are one text."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontamination.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (unsigned 32-bit, little-endian) and the digest of what they decode to."""
    made = bpe_chunks.encode_documents(docs, tokens.default_path())
    return made.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding and decoding", encode),
]

# The network, the sampling and the embedding have no SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(spark, docs, f"stage{i}")
    return docs
