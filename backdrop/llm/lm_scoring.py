"""Language-model scores by context-tree weighting.

A text is its bytes in UTF-8 with A to Z in lower case, and one end symbol. A
byte is eight binary decisions, each at a node of the binary tree over bytes.
For every such node there is a tree of contexts: the last 0 to ``DEPTH``
bytes. Each context keeps the counts of its decisions in the training texts
and their Krichevsky-Trofimov (KT) probability; the weighted probability of a
context is half its KT probability and half the product of the weighted
probabilities of the contexts that are one byte longer. The trained tree
predicts a decision by mixing the KT estimates of all contexts on its path,
each weighed by its share in that sum; contexts without counts are left out.

Beside it stands the base score: words under a unigram model with one added to
each count.

Neither model is ever in one place. A task turns its block of documents into
the distinct words and byte (``DEPTH`` + 1)-grams that it holds, with their
training counts, and asks for them by bucket; a bucket adds up the counts of
all blocks, weighs its contexts and answers each block; then the blocks are
scored. Contexts that share their last two bytes share a bucket, so only the
two topmost levels (at most 256 x 255 nodes) are put together on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from backdrop.llm.common import bounded_batches, documents, fold, stored, texts_of
from backdrop.llm.words import groups, word_hashes

DEPTH = 5
HELD_OUT_MOD, HELD_OUT = 7, 2
# Bytes of text for each bucket of words and of contexts.
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 16
# Distinct keys that are kept before equal ones are added up, or half as many as there are by then.
MERGE_KEYS = 1 << 20
# Grams whose contexts are weighed at once, or those of one last pair of bytes.
WEIGHED_GRAMS = 1 << 16

WORD, GRAM, TEXT = 0, 1, 2
# No word holds a line feed, no UTF-8 text the byte 255.
END_WORD, END_BYTE = b"\n", b"\xff"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(x: np.ndarray) -> bytes:
    """Numbers of eight bytes, compressed byte by byte."""
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def pack_rows(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def tokens_of(data: bytes) -> list[bytes]:
    """Words between ASCII white space, and the end."""
    return [*data.split(), END_WORD]


def grams_of(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (``DEPTH`` + 1)-gram that ends at each byte and each end, and how many each text has."""
    raw = np.frombuffer(b"".join(chain.from_iterable((END_BYTE * DEPTH, d, END_BYTE) for d in data)), np.uint8)
    grams = np.zeros(max(0, len(raw) - DEPTH), np.uint64)
    for i in range(DEPTH + 1):
        grams <<= np.uint64(8)
        grams |= raw[i : len(raw) - DEPTH + i]
    counts = np.array([len(d) + 1 for d in data], np.int64)
    use = np.ones(len(grams), bool)
    ends = np.cumsum(counts + DEPTH)[:-1]
    for i in range(1, DEPTH + 1):
        use[ends - i] = False
    return grams[use], counts


class Counter:
    """Distinct keys and their training counts."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.most = 0, MERGE_KEYS

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        distinct, place = np.unique(keys, return_inverse=True)
        self.parts.append((distinct, np.bincount(place, train, len(distinct)).astype(np.int64)))
        self.held += len(distinct)
        if self.held > self.most:
            self.parts = [self.total()]
            self.held, self.most = 0, max(MERGE_KEYS, len(self.parts[0][0]) // 2)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order and their counts, which are handed over."""
        if not self.parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([n for _, n in self.parts])
        self.parts = []  # not beside their copies
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def bucket_of(kind: int, keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Words by hash, grams by the two bytes before the last."""
    part = keys if kind == WORD else keys >> np.uint64(8) & np.uint64(0xFFFF)
    return ((part * _MIX >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int32)


def _ask(n_buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The documents of a block, and by bucket its distinct keys with their training counts."""
    names = ["kind", "bucket", "block", "keys", "counts"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        found = {WORD: Counter(), GRAM: Counter()}
        for b in batches:
            texts, train = texts_of(b.column(2)), ~np.array(b.column(1).to_pylist(), bool)
            for part in groups(texts):
                data = [t.encode().lower() for t in texts[part]]
                hashes, counts = word_hashes([tokens_of(d) for d in data])
                found[WORD].add(hashes, np.repeat(train[part], counts))
                grams, counts = grams_of(data)
                found[GRAM].add(grams, np.repeat(train[part], counts))
                rows = pack_rows(b.slice(part.start, len(data)))
                yield pa.RecordBatch.from_arrays([pa.array([TEXT], pa.int32()), pa.nulls(1, pa.int32()), pa.array([block], pa.int64()),
                                                  pa.array([rows], pa.binary()), pa.nulls(1, pa.binary())], names)
        for kind in (WORD, GRAM):
            keys, counts = found.pop(kind).total()
            bucket = bucket_of(kind, keys, n_buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)) if len(keys) else np.zeros(1, np.int64)
            for i in range(0, len(edges) - 1, 64):
                part = [order[s:e] for s, e in zip(edges[i : i + 64], edges[i + 1 : i + 65], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(part), pa.int32()), pa.array([bucket[x[0]] for x in part], pa.int32()),
                     pa.array([block] * len(part), pa.int64()), pa.array([pack_keys(keys[x]) for x in part], pa.binary()),
                     pa.array([pack(counts[x].astype("<i8")) for x in part], pa.binary())], names)

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 0.5, to about 1e-10."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the KT probability of so many decisions of either kind."""
    return np.where(zeros + ones > 0, log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi), 0)


class Level:
    """The nodes of one depth: their counts, KT and weighted probabilities."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> None:
        self.nodes, self.zeros, self.ones = nodes, zeros, ones
        kt = log_kt(zeros, ones)
        self.log_weighted = kt if below is None else np.logaddexp(kt, below) - np.log(2)
        # What the node's own estimate counts in the mixture, against the longer contexts.
        self.share = np.ones(len(nodes)) if below is None else np.exp(kt - np.log(2) - self.log_weighted)

    def mix(self, at: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Probability of ``bit`` at nodes ``at`` (their places); NaN where no context has counts."""
        n = self.zeros[at] + self.ones[at]
        own = (np.where(bit, self.ones[at], self.zeros[at]) + 0.5) / (n + 1.0)
        share = self.share[at]
        return np.where(n == 0, np.nan, np.where(np.isnan(deeper), own, share * own + (1 - share) * deeper))


def decisions(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The node (1 to 255) and the bit of the eight decisions (decision, gram) of each gram's last byte."""
    last = (grams & np.uint64(255)).astype(np.int64)
    return np.stack([1 << b | last >> 8 - b for b in range(8)]), np.stack([last >> 7 - b & 1 for b in range(8)]).astype(bool)


def deep_levels(grams: np.ndarray, counts: np.ndarray) -> tuple[list[Level], list[np.ndarray]]:
    """Levels ``DEPTH`` to 2 of the grams of a bucket, and the places of their decisions in each."""
    node, bit = decisions(grams)
    n = np.broadcast_to(counts, node.shape).ravel().astype(float)
    bit = bit.ravel()
    levels: list[Level] = []
    places: list[np.ndarray] = []
    below, ids = None, None
    for depth in range(DEPTH, 1, -1):
        context = (grams >> np.uint64(8) & np.uint64((1 << 8 * depth) - 1)).astype(np.int64)
        key, place = np.unique((context << 8 | node).ravel(), return_inverse=True)
        if levels:
            up = np.searchsorted(key, (ids >> 8 & (1 << 8 * depth) - 1) << 8 | ids & 255)
            below = np.bincount(up, levels[-1].log_weighted, len(key))
        levels.append(Level(key, np.bincount(place, n * ~bit, len(key)), np.bincount(place, n * bit, len(key)), below))
        places.append(place)
        ids = key
    return levels, places


def parts_of(grams: np.ndarray) -> Iterator[np.ndarray]:
    """Places of grams that share their last pairs of bytes before the last byte, and so all contexts of ``deep_levels``, in order, some at a time."""
    if not len(grams):
        return
    pair = (grams >> np.uint64(8)).astype(np.uint16)
    order = np.argsort(pair, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(pair[order].astype(np.int32))) + 1, len(grams))
    start = 0
    while start < len(grams):
        end = ends[max(np.searchsorted(ends, start + WEIGHED_GRAMS, "right") - 1, np.searchsorted(ends, start, "right"))]
        yield np.sort(order[start:end])
        start = end


def _merged(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Keys of each block, all distinct keys and their counts."""
    asked = [unpack_keys(x) for x in table.column("keys").to_pylist()]
    counter = Counter()
    for keys, n in zip(asked, table.column("counts").to_pylist(), strict=True):
        counter.parts.append((keys, unpack(n, "<i8")))
    return asked, *counter.total()


def _top(key: tuple, table: pa.Table) -> pa.Table:
    """What a bucket adds to the two topmost levels, or to the number of words and tokens."""
    _, keys, counts = _merged(table)
    if key[0].as_py() == WORD:
        rows = np.array([[-1, 0, 0, int((counts > 0).sum()), int(counts.sum())]], float)
    else:
        levels = [deep_levels(keys[x], counts[x])[0][-1] for x in parts_of(keys)]
        nodes = np.concatenate([x.nodes for x in levels])
        order = np.argsort(nodes)  # sums do not depend on the parts
        up, place = np.unique(nodes[order] & 0xFFFF, return_inverse=True)
        rows = np.column_stack([up >> 8, up & 255, *(np.bincount(place, np.concatenate(x)[order], len(up)) for x in (
            [y.log_weighted for y in levels], [y.zeros for y in levels], [y.ones for y in levels]))])
    return pa.table({"context": rows[:, 0].astype(np.int32), "node": rows[:, 1].astype(np.int32), "log_weighted": rows[:, 2],
                     "zeros": rows[:, 3].astype(np.int64), "ones": rows[:, 4].astype(np.int64)})


class Tree:
    """The topmost levels: contexts of one byte and of none."""

    def __init__(self, rows: list) -> None:
        zeros, ones, below = (np.zeros((256, 256)) for _ in range(3))
        for r in rows:
            zeros[r["context"], r["node"]] = r["zeros"]
            ones[r["context"], r["node"]] = r["ones"]
            below[r["context"], r["node"]] = r["log_weighted"]
        self.one = Level(np.arange(1 << 16), zeros.ravel(), ones.ravel(), below.ravel())
        self.none = Level(np.arange(256), zeros.sum(0), ones.sum(0), self.one.log_weighted.reshape(256, 256).sum(0))

    def log10(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte; ``counts`` are the training counts of all grams of its bucket."""
        out = np.empty(len(grams))
        for x in parts_of(grams):
            out[x] = self._log10(grams[x], counts[x])
        return out

    def _log10(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        node, bit = decisions(grams)
        shape, bit, node = node.shape, bit.ravel(), node.ravel()
        p = np.full(len(bit), np.nan)
        for level, place in zip(*deep_levels(grams, counts), strict=True):
            p = level.mix(place, bit, p)
        before = np.tile((grams >> np.uint64(8) & np.uint64(255)).astype(np.int64), 8)
        p = self.none.mix(node, bit, self.one.mix(before << 8 | node, bit, p))
        return np.log10(np.where(np.isnan(p), 0.5, p)).reshape(shape).sum(0)


def _answer(tree: Tree) -> Callable[[tuple, pa.Table], pa.Table]:
    """The value of each key that each block asked for: the count of words, log10 of the probability of grams (single precision)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        asked, keys, counts = _merged(table)
        values = counts.astype(float) if key[0].as_py() == WORD else tree.log10(keys, counts).astype("<f4").astype(float)
        said = [pack(values[np.searchsorted(keys, x)]) for x in asked]
        return pa.table({"kind": table.column("kind"), "block": table.column("block"), "keys": table.column("keys"),
                         "counts": pa.array(said, pa.binary())})

    return run


def _score(n_words: int, n_tokens: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scores of the documents of each block; its answers come before them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, known = None, {WORD: [], GRAM: []}, {}
        less = np.log10(n_tokens + n_words + 1.0)
        for b in batches:
            blocks, kinds = np.array(b.column(0)), np.array(b.column(1))
            for start in np.flatnonzero(np.diff(blocks, prepend=-1) | np.diff(kinds, prepend=-1)):
                stop = start + int(np.argmax(np.append((blocks[start:] != blocks[start]) | (kinds[start:] != kinds[start]), True)))
                rows = b.slice(start, stop - start)
                if blocks[start] != block:
                    block, parts, known = blocks[start], {WORD: [], GRAM: []}, {}
                if kinds[start] != TEXT:
                    parts[int(kinds[start])] += [(unpack_keys(k), unpack(v, "<f8"))
                                                 for k, v in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True)]
                    continue
                if not known:
                    for kind, found in parts.items():
                        keys = np.concatenate([k for k, _ in found])
                        order = np.argsort(keys)
                        known[kind] = keys[order], np.concatenate([v for _, v in found])[order]
                    parts = {WORD: [], GRAM: []}
                for packed in rows.column(2).to_pylist():
                    yield from (score_texts(x, known, less) for x in pa.ipc.open_stream(packed))

    def score_texts(rows: pa.RecordBatch, known: dict, less: float) -> pa.RecordBatch:
        data = [t.encode().lower() for t in texts_of(rows.column(2))]
        words, n = word_hashes([tokens_of(d) for d in data])
        counts = known[WORD][1].take(np.searchsorted(known[WORD][0], words))
        starts = np.cumsum(n) - n
        base, seen = np.add.reduceat(np.log10(counts + 1), starts), np.add.reduceat((counts > 0).astype(np.int64), starts)
        grams, n_bytes = grams_of(data)
        score = np.add.reduceat(known[GRAM][1].take(np.searchsorted(known[GRAM][0], grams)), np.cumsum(n_bytes) - n_bytes)
        return pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(n), pa.array(seen), pa.array([n_tokens] * len(data), pa.int64()),
             pa.array(base - n * less), pa.array(score), pa.array(-score * np.log2(10) / n_bytes)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = HELD_OUT_MOD,
                    held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row.

    Rows whose ``crc32(id) mod held_out_mod`` is ``held_out`` are not learned
    from. ``score`` is log10 of the probability of the text's bytes and its
    end under context-tree weighting, ``bits_per_byte`` its code length, the
    end counted as a byte. NULL counts as the empty text: one token, the end.
    Repeated rows are learned from and scored each; a NULL id counts as the
    empty string. Other columns are left out; an empty table gives no rows. If
    nothing can be learned from, every decision has probability 1/2.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    n_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_buckets = max(LEAST_BUCKETS, n_bytes // BUCKET_BYTES)
    id_type = docs.schema[id_col].dataType
    out = (fold(F.col(id_col), held_out_mod) == held_out).alias("held_out")
    rows = docs.select(F.col(id_col).alias("doc_id"), out, F.col(text_col).alias("text"))
    schema = StructType([StructField("kind", IntegerType()), StructField("bucket", IntegerType()), StructField("block", LongType()),
                         StructField("keys", BinaryType()), StructField("counts", BinaryType())])
    asked = stored(spark, rows.mapInArrow(_ask(n_buckets), schema), "lm-blocks")
    by_bucket = asked.where(F.col("kind") != TEXT).groupBy("kind", "bucket")
    top = by_bucket.applyInArrow(_top, "context int, node int, log_weighted double, zeros bigint, ones bigint")
    top = top.groupBy("context", "node").agg(*[F.sum(c).alias(c) for c in ("log_weighted", "zeros", "ones")]).collect()
    words = next((r for r in top if r["context"] < 0), {"zeros": 0, "ones": 0})
    tree = Tree([r for r in top if r["context"] >= 0])
    answers = by_bucket.applyInArrow(_answer(tree), "kind int, block bigint, keys binary, counts binary")
    texts = asked.where(F.col("kind") == TEXT).select("block", "kind", "keys", "counts")
    met = texts.unionByName(answers)
    met = met.repartition("block").sortWithinPartitions("block", "kind")
    result = StructType([StructField("doc_id", id_type), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
                         StructField("n_known", LongType()), StructField("train_tokens", LongType()), StructField("base_score", DoubleType()),
                         StructField("score", DoubleType()), StructField("bits_per_byte", DoubleType())])
    return met.mapInArrow(_score(int(words["zeros"]), int(words["ones"])), result)


def op7_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return score_documents(documents(spark, sf_dir))
