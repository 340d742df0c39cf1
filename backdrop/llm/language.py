"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter n-gram
binds (multiplies) the vectors of its letters, each permuted (rotated) by its
place in the n-gram. A text is the bundle (sum) of its n-grams, a language
prototype the bundle of all n-grams of its training texts, and a text gets the
language whose prototype has the largest cosine with it.

All bundles are sums of whole numbers, so they don't depend on how the rows
are dealt out.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from backdrop.llm.common import bounded_batches, documents, fold, texts_of

DIMENSIONS = 1024
NGRAM = 3
# Letters share vectors modulo this, so vectors take DIMENSIONS x 4096 bytes.
LETTERS = 4096
SEED = 4
UNKNOWN = "und"
# Characters and texts that are bundled together.
GROUP_CHARS = 1 << 20
GROUP_TEXTS = 256
HELD_OUT_MOD = 5


def letter_table() -> np.ndarray:
    """Which code points are letters, as packed bits."""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))


class Bundler:
    """N-gram counts and bundles of texts."""

    def __init__(self, letters: np.ndarray) -> None:
        self.is_letter = np.unpackbits(letters).astype(bool)
        vectors = np.random.default_rng(SEED).integers(0, 2, (LETTERS, DIMENSIONS), np.int8) * 2 - 1
        vectors[0] = 1  # the edge of a word binds as the identity
        self.permuted = [np.roll(vectors, NGRAM - 1 - i, 1) for i in range(NGRAM)]

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, n-gram and count. N-grams stay within a word and its edges."""
        low = [t.lower() for t in texts]
        points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
        of = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])[: len(points)]
        symbol = np.where(self.is_letter[points], points % (LETTERS - 1) + 1, 0).astype(np.int64)
        keep = symbol > 0
        keep[1:] |= symbol[:-1] > 0
        symbol, of = np.concatenate([[0], symbol[keep], [0]]), of[keep]
        if len(of) == 0:
            return (np.empty(0, np.int64),) * 3
        gram = (symbol[:-2] * LETTERS + symbol[1:-1]) * LETTERS + symbol[2:]
        inside = symbol[1:-1] > 0
        key, n = np.unique(of[inside] << 36 | gram[inside], return_counts=True)
        return key >> 36, key & ((1 << 36) - 1), n

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        out = self.permuted[2][grams % LETTERS]
        out *= self.permuted[1][grams // LETTERS % LETTERS]
        out *= self.permuted[0][grams // LETTERS**2]
        return out

    def bundles(self, of: np.ndarray, grams: np.ndarray, n: np.ndarray, rows: int) -> np.ndarray:
        """One bundle a row. Single precision is exact for sums below 2 ** 24."""
        distinct, place = np.unique(grams, return_inverse=True)
        counts = np.zeros((rows, len(distinct)), np.float64 if len(n) and n.sum() >= 1 << 24 else np.float32)
        np.add.at(counts, (of, place), n)
        return counts @ self.vectors(distinct).astype(counts.dtype)


def _groups(texts: list[str]) -> Iterator[slice]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and (held + len(t) > GROUP_CHARS or i - start >= GROUP_TEXTS):
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _learn(letters: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(letters)
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), texts_of(b.column(1))
            for part in _groups(texts):
                names = sorted(set(langs[part]))
                number = {x: i for i, x in enumerate(names)}
                of, grams, n = bundler.counts(texts[part])
                which = np.array([number[x] for x in langs[part]])
                made = bundler.bundles(which[of] if len(of) else of, grams, n, len(names))
                for x, v in zip(names, made, strict=True):
                    total[x] = total.get(x, 0) + v.astype(np.int64)
        names = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([total[x].tolist() for x in names], pa.list_(pa.int64()))], ["lang", "bundle"])

    return run


def prototypes(rows: DataFrame, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Languages and the bundle of each from (lang, text) rows: one vector a language reaches the driver."""
    schema = StructType([StructField("lang", StringType()), StructField("bundle", ArrayType(LongType()))])
    parts = rows.select("lang", "text").mapInArrow(_learn(letters), schema)
    summed = parts.select("lang", F.posexplode("bundle")).groupBy("lang", "pos").agg(F.sum("col").alias("v"))
    found = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("b")).orderBy("lang").collect()
    return [r.lang for r in found], np.array([[x.v for x in r.b] for r in found], np.float64).reshape(len(found), DIMENSIONS)


def _predict(langs: list[str], protos: np.ndarray, letters: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(letters)
        unit = (protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-30)).T if langs else None
        for b in batches:
            texts = texts_of(b.column(1))
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for part in _groups(texts):
                of, grams, n = bundler.counts(texts[part])
                if unit is None or not len(of):
                    continue
                made = bundler.bundles(of, grams, n, part.stop - part.start).astype(np.float64)
                norm = np.linalg.norm(made, axis=1)
                cosine = made @ unit / np.maximum(norm, 1e-30)[:, None]
                for i in np.unique(of):
                    names[part.start + i] = langs[int(cosine[i].argmax())]
                    scores[part.start + i] = min(1.0, max(0.0, cosine[i].max()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(names, pa.string()), pa.array(scores)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             held_out_mod: int = HELD_OUT_MOD) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    Prototypes are learned from all rows with a language whose
    ``crc32(id) mod held_out_mod`` is not 0; that remainder is held out. A
    prediction has the text as its only input. The score is the cosine with
    the predicted prototype, at least 0. A text that is NULL or has no letter
    gets ``und`` and 0, as does every text if nothing could be learned. Ties
    go to the first language by name; repeated rows are learned from and
    predicted each; other columns are left out; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    letters = letter_table()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       (fold(F.col(id_col), held_out_mod) == 0).alias("held_out"), F.col(lang_col).alias("lang"))
    langs, protos = prototypes(rows.where("lang is not null and not held_out"), letters)
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), rows.schema["held_out"],
                         StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.select("doc_id", "text", "held_out").mapInArrow(_predict(langs, protos, letters), schema)


def op4_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return identify(documents(spark, sf_dir))
