"""Small tables with every awkward case."""

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

WORDS = [a + b + c for a in ("ba", "ke", "lo", "mi", "nu", "sta") for b in ("ra", "te", "vo", "xi") for c in ("n", "s", "lt", "")]

# Names that the operators use inside, borne by columns that must not matter.
EXTRA = ["shard", "score", "row", "kept", "node", "block", "sha", "held_out", "c0", "size", "term", "key"]

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                     StructField("source", StringType()), StructField("n_chars", LongType()),
                     *[StructField(c, StringType()) for c in EXTRA]])


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, None, *["x"] * len(EXTRA))


def awkward():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = prose(1, 30_000)
    return [row(1, None), row(2, ""), row(3, "  \n\t "), row(None, "no id at all"), row(None, None), row(4, long), row(5, long),
            row(6, prose(6, 80)), row(6, prose(6, 80)), row(7, prose(6, 80)), row(8, "x" * 70_000), row(9, "one"), row(10, "a\x1cb !\x1d"),
            row(11, "<|endoftext|> hi<|endoftext|>  "), row(12, "你好 世界。" * 50, None), row(13, "éàü", "fr"), row(-5, prose(14, 7))]


@pytest.fixture()
def table(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def docs(table):
    return table(awkward())


@pytest.fixture()
def empty(table):
    return table([])
