"""Benchmark decontamination under edit distance.

A CGK embedding reads a sequence of words by a random walk: at step ``t`` it
puts out the word under its head and moves on by a random bit of (t, word).
Two sequences at a small edit distance fall into step again after each edit,
so their outputs are at a small Hamming distance. Words have 64-bit hashes,
and bit ``t`` of the hash is the random bit.

Bit-sampling LSH: a key takes the outputs at a few random steps. A window of a
document and a passage of an item that agree in any one of many keys are a
candidate pair, which the exact edit distance then decides.

Windows start at every word. They have the size of the items, in classes of
powers of two: an item of n words is looked for by passages of the largest
class that it holds, which begin at every half passage and at its end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from backdrop.llm.common import bounded_batches, documents, texts_of
from backdrop.llm.words import groups, word_hashes

# A document holds an item if some passage of it has at least this edit similarity with it.
SIMILARITY = 0.8
# Passages of over LARGEST_CLASS words are looked for by their parts.
LARGEST_CLASS = 16
STEPS = LARGEST_CLASS * 3 // 2
# Keys are taken from WALKS independent walks, KEYS from each, of SAMPLES outputs each.
WALKS = 2
KEYS = 8
SAMPLES = 4
SEED = 3
# Items that are looked for in one scan of the documents, by number and by bytes of text.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
# Windows that are embedded together, so that their keys stay in the cache.
BLOCK_WINDOWS = 1 << 13

_WORD = re.compile(r"\w+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PAD = np.uint64(0x5851F42D4C957F2D)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def class_of(n: int) -> int:
    """The largest power of two that is at most n, at most ``LARGEST_CLASS``; n itself below 8."""
    return n if n < 8 else min(LARGEST_CLASS, 1 << n.bit_length() - 1)


@lru_cache(None)
def sample_steps(size: int, walk: int) -> np.ndarray:
    """Steps of each key of a class, within the time that the walk stays inside a passage."""
    rng = np.random.default_rng([SEED, size, walk])
    last = max(1, size * 3 // 2)
    return np.stack([np.sort(rng.choice(last, min(SAMPLES, last), replace=False)) for _ in range(KEYS)])


def keys_of(words: np.ndarray, starts: np.ndarray, sizes: list[int], walk: int) -> dict[int, np.ndarray]:
    """Keys (key, start) of the windows at ``starts`` for each class; ``words`` must end in ``STEPS`` more words."""
    at = {size: sample_steps(size, walk) for size in sizes}
    by_step: dict[int, list[np.ndarray]] = {}
    keys = {size: np.zeros((KEYS, len(starts)), np.uint64) for size in sizes}
    for size in sizes:
        for k, steps in enumerate(at[size]):
            for t in steps.tolist():
                by_step.setdefault(t, []).append(keys[size][k])
    head = starts.copy()
    for t in range(1 + max(by_step)):
        out = words.take(head)
        for key in by_step.get(t, ()):
            key *= _MULTIPLIER
            key += out
        head += (out >> np.uint64(t) & np.uint64(1)).view(np.int64)
    for key in keys.values():
        key *= _MULTIPLIER
    return keys


def walk_words(hashes: np.ndarray, walk: int) -> np.ndarray:
    """The hashes that steer a walk: another mix of them for each."""
    x = (hashes ^ np.uint64(walk * 0x2545F4914F6CDD1D & (1 << 64) - 1)) * _MULTIPLIER
    return x ^ x >> np.uint64(29)


class ItemIndex:
    """Keys of a block of items."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        tokens = [words_of(t) for t in texts]
        self.ids = ids
        self.items = [word_hashes([t])[0] for t in tokens]
        self.masks: list[dict[int, int]] = []
        for item in self.items:
            mask: dict[int, int] = {}
            for i, h in enumerate(item.tolist()):
                mask[h] = mask.get(h, 0) | 1 << i
            self.masks.append(mask)
        passages: dict[int, list[tuple[int, int]]] = {}
        for i, item in enumerate(self.items):
            if n := len(item):
                size = class_of(n)
                at = {*range(0, n - size + 1, max(1, size // 2)), n - size}
                passages.setdefault(size, []).extend((i, o) for o in sorted(at))
        self.sizes = sorted(passages)
        pad = np.full(STEPS + 1, _PAD, np.uint64)
        flat = np.concatenate([*[np.concatenate([x, pad]) for x in self.items], pad])
        base = np.cumsum([0, *[len(x) + len(pad) for x in self.items]])
        bits = 12
        while 1 << bits < 256 * max([1, *map(len, passages.values())]):
            bits += 1
        self.shift = np.uint64(64 - min(bits, 26))
        # Of each class, walk and key: which leading bits occur, the keys in order, and their passages.
        self.tables: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.passages = {size: np.array(found, np.int64) for size, found in passages.items()}
        for walk in range(WALKS):
            mixed = walk_words(flat, walk)
            for size, found in self.passages.items():
                keys = keys_of(mixed, base[found[:, 0]] + found[:, 1], [size], walk)[size]
                for k in range(KEYS):
                    order = np.argsort(keys[k], kind="stable")
                    there = np.zeros(1 << int(64 - self.shift), bool)
                    there[keys[k] >> self.shift] = True
                    self.tables[size, walk, k] = there, keys[k][order], order

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """(window start, item, offset of the passage in the item), each once."""
        padded = np.concatenate([hashes, np.full(STEPS + 1, _PAD, np.uint64)])
        found = [np.empty((0, 3), np.int64)]
        if self.sizes:
            for walk in range(WALKS):
                mixed = walk_words(padded, walk)
                for first in range(0, len(hashes), BLOCK_WINDOWS):
                    starts = np.arange(first, min(first + BLOCK_WINDOWS, len(hashes)))
                    for size, keys in keys_of(mixed, starts, self.sizes, walk).items():
                        for k in range(KEYS):
                            found.append(self._hits(size, walk, k, keys[k], first))
        return np.unique(np.concatenate(found), axis=0)

    def _hits(self, size: int, walk: int, k: int, keys: np.ndarray, first: int) -> np.ndarray:
        there, known, order = self.tables[size, walk, k]
        maybe = np.flatnonzero(there.take((keys >> self.shift).view(np.int64)))
        if not len(maybe):
            return np.empty((0, 3), np.int64)
        low, high = (np.searchsorted(known, keys[maybe], side) for side in ("left", "right"))
        n = high - low
        where = np.repeat(maybe, n)
        rank = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.column_stack([where + first, self.passages[size][order[rank]]])

    def distance(self, item: int, hashes: list[int], most: int) -> tuple[int, int] | None:
        """Smallest edit distance of an item from any passage of the words, and where it ends; None beyond ``most``."""
        n, masks = len(self.items[item]), self.masks[item]
        held = 0
        for h in masks.keys() & set(hashes):
            held |= masks[h]
        if n - held.bit_count() > most:  # each word of the item that the passage lacks costs an edit
            return None
        full, top = (1 << n) - 1, 1 << n - 1
        plus, minus, score, best, end = full, 0, n, n, 0
        for j, h in enumerate(hashes):  # Myers' bit vectors: a column of the distance matrix in two numbers
            eq = masks.get(h, 0)
            vertical = eq | minus
            horizontal = ((eq & plus) + plus ^ plus) | eq
            up = minus | full & ~(horizontal | plus)
            down = plus & horizontal
            score += bool(up & top) - bool(down & top)
            up, down = up << 1 & full, down << 1 & full
            plus, minus = down | full & ~(vertical | up), up & vertical
            if score < best:
                best, end = score, j + 1
        return (best, end) if best <= most else None

    def leaks(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """(item, distance, first word, end word) of the best passage of each item that each text holds."""
        hashes, counts = word_hashes([words_of(t) for t in texts])
        ends = np.cumsum(counts)
        found = self.candidates(hashes)
        of = np.searchsorted(ends, found[:, 0], "right")
        begin = found[:, 0] - found[:, 2]
        order = np.lexsort((begin, found[:, 1], of))
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        last: tuple[int, int, int] = (-1, -1, 0)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, at in zip(of[order].tolist(), found[order, 1].tolist(), begin[order].tolist(), strict=True):
            if last[:2] == (doc, item) and at <= last[2]:
                continue  # the passage that was read before covers it
            n = len(self.items[item])
            most = int(n * (1 - SIMILARITY) + 1e-9)
            low = max(int(ends[doc] - counts[doc]), at - most)
            high = min(int(ends[doc]), at + 2 * most + n + 1)
            last = (doc, item, at + most)
            hit = self.distance(item, hashes[low:high].tolist(), most)
            if hit and hit[0] < best.get((doc, item), (most + 1,))[0]:
                end = low + hit[1] - int(ends[doc] - counts[doc])
                best[doc, item] = (hit[0], max(0, end - n), end)
        for (doc, item), (distance, start, end) in best.items():
            out[doc].append((item, distance, start, end))
        return out


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[ItemIndex]:
    """Indexes of all items, in blocks of a bounded size, so that a benchmark of any size can be looked for."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n = max(-(-size.n // BLOCK_ITEMS), -(-(size.bytes or 0) // BLOCK_BYTES))
    for block in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).orderBy("id", "text").toPandas()
        yield ItemIndex(part["id"].tolist(), part["text"].tolist())


def _search(index: ItemIndex, id_type: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b.column(1))
            for part in groups(texts):
                found = [(part.start + i, *x) for i, rows in enumerate(index.leaks(texts[part])) for x in rows]
                row, item, distance, start, end = zip(*found, strict=True) if found else ((),) * 5
                n = np.array([len(index.items[i]) for i in item], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), pa.array([index.ids[i] for i in item], id_type),
                     pa.array(distance, pa.int64()), pa.array(1 - np.array(distance) / np.maximum(n, 1), pa.float64()),
                     pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["doc_id", "item_id", "distance", "similarity", "start_word", "end_word"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every document and item of which the document holds a passage at an edit similarity of ``SIMILARITY`` or more.

    Returns doc_id, item_id, distance (words), similarity, start_word and
    end_word of the best passage, the first of equals. Words are runs of
    letters, digits and underscores in lower case. Texts and items that are
    NULL or hold no word match nothing. Repeated rows and repeated items match
    each; other columns are left out; without documents or items there are no
    rows.
    """
    bounded_batches(docs.sparkSession)
    from backdrop.llm.common import arrow_type

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item_type = benchmark.schema[item_col].dataType
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("item_id", item_type),
                         StructField("distance", LongType()), StructField("similarity", DoubleType()),
                         StructField("start_word", LongType()), StructField("end_word", LongType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for index in item_blocks(benchmark, item_col, item_text_col):
        out = out.unionByName(rows.mapInArrow(_search(index, arrow_type(item_type)), schema))
    return out


def _clean(index: ItemIndex, text_at: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b.column(text_at))
            keep = [not rows for part in groups(texts) for rows in index.leaks(texts[part])]
            yield b.filter(pa.array(keep, pa.bool_()))

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    bounded_batches(docs.sparkSession)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    for index in item_blocks(benchmark, item_col, item_text_col):
        plain = plain.mapInArrow(_clean(index, docs.columns.index(text_col)), plain.schema)
    return plain.toDF(*docs.columns)


def op3_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all benchmark items in all documents."""
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))
