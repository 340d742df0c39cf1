"""Token counts: batches in, lengths out.

Texts are encoded inside Arrow functions in batches of about ``BATCH_BYTES``
bytes: long texts are split at safe boundaries (see ``tokens``) into
parts, short ones share a batch, so every batch costs about the same. Only
lengths leave the function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from backdrop.llm import tokens
from backdrop.llm.common import bounded_batches, documents, kept_by_worker, texts_of

BATCH_BYTES = 1 << 20
# The fold of the contract: longer documents are flagged.
TOKEN_LIMIT = 512


def balanced(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Batches of (text number, part), each of about ``BATCH_BYTES`` bytes in UTF-8.

    Texts longer than that are split at safe boundaries and dealt out over
    several batches. A part may be longer if it has no boundary to be split at.
    """
    batch: list[tuple[int, str]] = []
    held = 0
    for i, text in enumerate(texts):
        # A character has at most four bytes, so no part of a text exceeds a batch.
        for part in tokens.slices(text, BATCH_BYTES // 4):
            size = len(part.encode())
            if batch and held + size > BATCH_BYTES:
                yield batch
                batch, held = [], 0
            batch.append((i, part))
            held += size
    if batch:
        yield batch


def _lengths(tokenizer_json: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("pieces", hash(tokenizer_json)), lambda: tokens.PieceEncoder(tokenizer_json))
        for b in batches:
            texts = texts_of(b.column(1))
            counts = [0] * len(texts)
            for batch in balanced(texts):
                split = [tokens.pieces(part) for _, part in batch]
                ids = encoder.learn([p for found in split for p in found])
                for (i, _), found in zip(batch, split, strict=True):
                    counts[i] += sum(map(len, map(ids.__getitem__, found))) // 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row under a byte-level BPE tokenizer file.

    NULL and empty texts have 0 bytes and 0 tokens. Special strings inside
    texts count as the tokenizer file has it. Repeated rows are counted each,
    a NULL id is kept; other columns are left out; an empty table gives no rows.
    A very long text is split at safe boundaries; a stretch without white space,
    be it the whole text, is encoded at once.
    """
    bounded_batches(docs.sparkSession)
    spec = tokens.tokenizer_text(tokenizer_path)
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("n_bytes", LongType()),
                         StructField("n_tokens", LongType())])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_lengths(spec), schema)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents; those over ``TOKEN_LIMIT`` are flagged."""
    counts = token_counts(documents(spark, sf_dir), tokens.default_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
