"""Near duplicates under the weighted Jaccard similarity of TF-IDF shingles.

A text is the set of its five-word shingles, each weighing its count in the
text times ``1 + ln((N + 1) / (df + 1)) / ln(N + 2)``, where ``df`` is its
number of documents. The counts are exact and never in one place: batches of
texts ask for their shingles by slice, a slice adds up what it is asked for,
and the answer names the shingles of more than one document.

Improved consistent weighted sampling (Ioffe) draws ``SAMPLES`` samples of
each text, which two texts share with the probability of their weighted
Jaccard similarity, and as many plain minima, which they share with that of the
plain shingle sets. Only texts that can be near to another are sampled: their
shingles of more than one document must make up ``SIMILARITY`` of the text. Bands
of either kind are buckets. In a bucket, a maximum spanning forest by the share
of equal samples joins most of a class without listing its pairs; of a large
bucket, each block meets the next. The links of the forest are then verified on
the shingles: a pair is near if its weighted Jaccard similarity, or that of the
plain shingle sets, is ``SIMILARITY`` or more. The share is an estimate, so a
forest may hold a pair that fails in place of one that would not: all other
pairs of a bucket that the verified links leave apart are verified where the
bucket, or two of its blocks, meets, and only links that join more of it are
named. Classes are the connected components.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from backdrop.llm.common import bounded_batches, documents, keep_rows, release_shuffles, stored, texts_of
from backdrop.llm.components import components
from backdrop.llm.words import groups, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS = 12
ROWS = 4
SAMPLES = BANDS * ROWS
# Pairs of a bucket with a smaller share of equal samples, of both kinds, are
# not verified: five standard deviations below SIMILARITY.
LEAST_SHARE = 0.5
# Texts of a bucket in a block, and bytes of their shingles; two blocks meet in a group.
BLOCK = 512
BLOCK_BYTES = 8 << 20
# Shingles that are compared with those of one text at once.
COMPARED = 1 << 20
# Bytes of text to a slice of the document frequencies, and the fewest and most bits of a slice's number.
SLICE_BYTES = 8 << 20
SLICE_BITS = (6, 16)
# Characters of text that ask together, for each slice, and at most.
ASK_CHARS = 1 << 13
MOST_ASK_CHARS = 1 << 25
# Rows of a batch at most, however short.
BATCH_ROWS = 1 << 17
DRAW_BITS = 16
SEED = 6

_ODD = np.random.default_rng([SEED, 1]).integers(0, 1 << 63, 64 + SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_PLAIN = np.random.default_rng([SEED, 3]).integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHINGLE = np.uint64(0x9E3779B97F4A7C15)
_BAND = np.concatenate([_ODD[8 : 8 + BANDS], _PLAIN[:BANDS]])


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle (52 bits) and count of each distinct shingle, by text and shingle.

    Words are what white space separates, in lower case. A text of fewer than
    ``WORDS`` words is one shingle, a text without words has none.
    """
    hashes, counts = word_hashes([t.lower().split() for t in texts])
    ends = np.cumsum(counts)
    rolled = np.zeros(len(hashes), np.uint64)
    mixed = hashes.copy()
    for i in range(WORDS):
        rolled[: len(hashes) - i] += mixed[i:]
        mixed *= _SHINGLE
    of = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(hashes)) - np.repeat(ends - counts, counts)
    use = place <= np.repeat(counts, counts) - WORDS
    for i in np.flatnonzero((counts > 0) & (counts < WORDS)):
        first = ends[i] - counts[i]
        use[first] = True
        rolled[first] = np.bitwise_xor.reduce(hashes[first : ends[i]] * _ODD[: counts[i]]) + np.uint64(counts[i])
    rolled ^= rolled >> np.uint64(31)
    key, n = np.unique(of[use].astype(np.uint64) << np.uint64(52) | (rolled[use] * _SHINGLE) >> np.uint64(12), return_counts=True)
    return (key >> np.uint64(52)).astype(np.int64), key & np.uint64((1 << 52) - 1), n


def few(texts: list[str]) -> Iterator[slice]:
    """Groups of texts that ``shingles`` can number."""
    for part in groups(texts):
        for i in range(part.start, part.stop, 4096):
            yield slice(i, min(i + 4096, part.stop))


def folded(texts: list[str]) -> bytes:
    """Texts as one compressed value."""
    raw = [t.encode() for t in texts]
    return zstandard.ZstdCompressor(level=3).compress(np.array([len(texts), *map(len, raw)], "<u4").tobytes() + b"".join(raw))


def unfolded(data: bytes) -> list[str]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = 4 * (n + 1) + np.cumsum(np.frombuffer(raw, "<u4", n, 4).astype(np.int64))
    return [raw[i:j].decode() for i, j in zip([4 * (n + 1), *ends.tolist()], ends.tolist(), strict=False)]


def _batched(chars: int, schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows that follow each other, of about ``chars`` characters together, as one row: its number, ids, nodes and folded texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch, held, rows = TaskContext.get().partitionId() << 32, 0, []

        def made() -> pa.RecordBatch:
            ids, nodes, texts = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((batch, ids, nodes, folded(texts)), schema, strict=True)], schema=schema)

        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2)), strict=True):
                rows.append(row)
                held += len(row[2])
                if held >= chars or len(rows) >= BATCH_ROWS:
                    yield made()
                    batch, held, rows = batch + 1, 0, []
        if rows:
            yield made()

    return run


def packed(found: np.ndarray) -> bytes:
    """Shingles in order, without what their slice says: the low 32 bits of each, and the steps of the next 16."""
    steps = np.diff((found >> np.uint64(32)).astype(np.uint16), prepend=np.uint16(0))
    return found.astype("<u4").tobytes() + zlib.compress(steps.astype("<u2").tobytes(), 1)


def unpacked(data: bytes, n: int, part: int, bits: int) -> np.ndarray:
    high = np.cumsum(np.frombuffer(zlib.decompress(data[4 * n :]), "<u2"), dtype=np.uint16).astype(np.uint64) << np.uint64(32)
    return np.frombuffer(data, "<u4", n) | high | np.uint64(part >> bits - 4 << 48)


def kept_shingles(found: np.ndarray, n: np.ndarray, df: np.ndarray, rest: tuple[float, int]) -> bytes:
    """Shingles of a text with their counts and document frequencies, and the weight and number of all others."""
    keys = found.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].T.tobytes()
    return struct.pack("<Idq", len(found), *rest) + keys + zlib.compress(n.astype("<u4").tobytes() + df.astype("<u4").tobytes(), 1)


def unkept(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[float, int]]:
    size, *rest = struct.unpack_from("<Idq", data)
    start = struct.calcsize("<Idq")
    keys = np.zeros((size, 8), np.uint8)
    keys[:, :7] = np.frombuffer(data, np.uint8, 7 * size, start).reshape(7, -1).T
    n, df = np.frombuffer(zlib.decompress(data[start + 7 * size :]), "<u4").reshape(2, -1)
    return keys.view("<u8").ravel(), n, df, tuple(rest)


def squeezed(n: np.ndarray) -> bytes:
    """Counts, most of them alike."""
    return zlib.compress(n.astype("<u4").tobytes(), 1)


def counts_of(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4")


def _ask(bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(slice, batch, shingles, n): the shingles of the texts of a batch, and of how many they are."""
    edges = np.arange((1 << bits) + 1).astype(np.uint64) << np.uint64(52 - bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for batch, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                texts = unfolded(blob)
                found, n = np.unique(np.concatenate([np.empty(0, np.uint64), *[shingles(texts[part])[1] for part in few(texts)]]), return_counts=True)
                at = np.searchsorted(found, edges)
                there = np.flatnonzero(np.diff(at)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(there, pa.int32()), pa.array([batch] * len(there), pa.int64()),
                     pa.array([packed(found[at[i] : at[i + 1]]) for i in there], pa.binary()),
                     pa.array([squeezed(n[at[i] : at[i + 1]]) for i in there], pa.binary())], ["slice", "batch", "shingles", "n"])

    return run


def _answer(bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each request, which come sorted by slice, its shingles of more than one document (slice, batch, shingles, n)."""

    def answered(part: int, asked: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        counts = [counts_of(n) for _, _, n in asked]
        sizes = [len(n) for n in counts]
        found, which = np.unique(np.concatenate([unpacked(x, n, part, bits) for (_, x, _), n in zip(asked, sizes, strict=True)]), return_inverse=True)
        total = np.bincount(which, np.concatenate(counts), len(found)).astype(np.uint32)
        rows = []
        for (batch, _, _), w in zip(asked, np.split(which, np.cumsum(sizes)[:-1]), strict=True):
            w = w[total[w] > 1]
            if len(w):
                rows.append((batch, packed(found[w]), squeezed(total[w])))
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(rows), pa.int32()), pa.array([x[0] for x in rows], pa.int64()),
             pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows], pa.binary())], ["slice", "batch", "shingles", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []
        for b in batches:
            for part, *one in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != now:
                    if asked:
                        yield answered(now, asked)
                    now, asked = part, []
                asked.append(one)
        if asked:
            yield answered(now, asked)

    return run


def exact_frequencies(rows: DataFrame, bits: int) -> DataFrame:
    """(slice, batch, shingles, n): for each batch its shingles of more than one row, and of how many they are."""
    schema = StructType([StructField("slice", IntegerType()), StructField("batch", LongType()),
                         StructField("shingles", BinaryType()), StructField("n", BinaryType())])
    asked = rows.select("batch", "texts").mapInArrow(_ask(bits), schema)
    return asked.repartition("slice").sortWithinPartitions("slice").mapInArrow(_answer(bits), schema)


class Weigher:
    """Weights of shingles and samples of texts, by their document frequencies."""

    def __init__(self, n_docs: int) -> None:
        self.n_docs = n_docs
        rng = np.random.default_rng([SEED, 2])
        size = 1 << DRAW_BITS
        self.rate = rng.gamma(2, 1, size).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, size)).astype(np.float32)
        self.beta = rng.random(size).astype(np.float32)

    def weights(self, found: np.ndarray, n: np.ndarray, df: np.ndarray) -> np.ndarray:
        return n * (1 + np.log((self.n_docs + 1) / (df + 1.0)).clip(0) / np.log(self.n_docs + 2))

    def samples(self, of: np.ndarray, found: np.ndarray, n: np.ndarray, df: np.ndarray) -> np.ndarray:
        """Samples (sample, text) of the texts that occur in ``of``: the drawn shingle and level as one number."""
        log_w = np.log(self.weights(found, n, df)).astype(np.float32)
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        low = found & np.uint64(0xFFFFFFFF)
        out = np.empty((SAMPLES, len(starts)), np.uint64)
        for k in range(SAMPLES):
            draw = ((found * _ODD[k]) >> np.uint64(64 - DRAW_BITS)).view(np.int64)
            r, beta = self.rate.take(draw), self.beta.take(draw)
            level = np.floor(log_w / r + beta)
            a = self.log_c.take(draw) - r * (level - beta + 1) + np.float32(256)  # over 0, so its bits are in order
            key = np.maximum(a, 0).view(np.uint32).astype(np.uint64) << np.uint64(32) | low
            out[k] = np.minimum.reduceat(key, starts)
        return out


def plain_samples(of: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Samples (sample, text) of the texts that occur in ``of`` by their shingle sets: the least mix of a shingle."""
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    out = np.empty((SAMPLES, len(starts)), np.uint64)
    for k in range(SAMPLES):
        mixed = found * _PLAIN[k]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _SHINGLE
        out[k] = np.minimum.reduceat(mixed, starts)
    return out


def _signatures(weigher: Weigher, bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bands, samples and shared shingles of the texts that can be near to others; the rows come sorted by batch, its frequencies first."""

    def hopeful(starts: np.ndarray, weights: np.ndarray, often: np.ndarray) -> np.ndarray:
        """Whether shingles of several documents make up enough of each text: no similarity exceeds their part."""
        part = lambda x: np.add.reduceat(x * often, starts) / np.add.reduceat(x, starts)
        return np.maximum(part(weights), part(np.ones(len(weights)))) >= SIMILARITY - 1e-9

    def signed(ids: pa.Array, nodes: pa.Array, texts: list[str], known: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        of, found, n = shingles(texts)
        bands: list = [None] * len(texts)
        signs: list = [None] * len(texts)
        shared: list = [None] * len(texts)
        if len(of):
            df = np.ones(len(found), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                df = np.where(known[at] == found, times[at], df)
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            weights = weigher.weights(found, n, df)
            use = np.repeat(hopeful(starts, weights, df > 1), np.diff(starts, append=len(of)))
            of, found, n, df, weights = of[use], found[use], n[use], df[use], weights[use]
        if len(of):
            # Weighted samples first, then plain ones; no band of one kind meets one of the other.
            drawn = np.concatenate([weigher.samples(of, found, n, df), plain_samples(of, found)])
            drawn = (drawn ^ drawn >> np.uint64(29)) * _SHINGLE
            band = (drawn.reshape(2 * BANDS, ROWS, -1) * _ODD[:ROWS, None]).sum(1) * _BAND[:, None]
            signs_of = np.ascontiguousarray((drawn >> np.uint64(32)).astype("<u4").T)
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            for j, (i, a, z) in enumerate(zip(of[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(of)], strict=True)):
                bands[i], signs[i] = band[:, j].view(np.int64).tolist(), signs_of[j].tobytes()
                often = df[a:z] > 1
                rest = float(weights[a:z][~often].sum()), int((~often).sum())
                shared[i] = kept_shingles(found[a:z][often], n[a:z][often], df[a:z][often], rest)
        return pa.RecordBatch.from_arrays([ids, nodes, pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary()), pa.array(shared, pa.binary())],
                                          ["doc_id", "node", "bands", "sign", "shared"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.uint64), np.empty(0, np.uint32))]
        for b in batches:
            for i, part in enumerate(b.column(1).to_pylist()):
                if part is not None:
                    times = counts_of(b.column(6)[i].as_py())
                    answers.append((unpacked(b.column(5)[i].as_py(), len(times), part, bits), times))
                    continue
                known, first = np.unique(np.concatenate([x for x, _ in answers]), return_index=True)
                times = np.concatenate([x for _, x in answers])[first].astype(np.int64)
                del answers[1:]
                texts = unfolded(b.column(4)[i].as_py())
                ids, nodes = b.column(2)[i].values, b.column(3)[i].values
                for some in few(texts):
                    n = some.stop - some.start
                    yield signed(ids.slice(some.start, n), nodes.slice(some.start, n), texts[some], known, times)

    return run


def shares(signs: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """The share of equal samples of each row with one, of the kind of samples that has the larger."""
    return (signs == sign).reshape(len(signs), -1, SAMPLES).mean(2).max(1)


def forest(signs: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest of the rows by their share of equal samples, pairs below ``LEAST_SHARE`` left out."""
    m = len(signs)
    best, near = np.full(m, -1.0), np.zeros(m, np.int64)
    out: list[tuple[int, int]] = []
    left = np.ones(m, bool)
    at = 0
    for _ in range(m - 1):
        left[at] = False
        rest = np.flatnonzero(left)
        share = shares(signs[rest], signs[at])
        closer = share > best[rest]
        best[rest[closer]], near[rest[closer]] = share[closer], at
        at = int(rest[best[rest].argmax()])
        if best[at] >= LEAST_SHARE:
            out.append((int(near[at]), at))
    return out


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each group; the rows come sorted by group."""
    key, nodes, signs = None, [], []

    def made() -> pa.RecordBatch:
        pairs = forest(np.stack([np.frombuffer(s, "<u4") for s in signs])) if len(nodes) > 1 else []
        ends = [sorted((nodes[i], nodes[j])) for i, j in pairs]
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in ends], pa.binary()), pa.array([b for _, b in ends], pa.binary())], ["a", "b"])

    for b in batches:
        for *k, node, sign in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if k != key:
                if len(nodes) > 1:
                    yield made()
                key, nodes, signs = k, [], []
            nodes.append(node)
            signs.append(sign)
    if len(nodes) > 1:
        yield made()


def similarity(x: tuple, y: tuple, rest_x: tuple = (0.0, 0), rest_y: tuple = (0.0, 0)) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two (shingles, weights), shingles in order; the rests are weight and number of shingles of one only."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    least = np.minimum(x[1][i], y[1][j]).sum()
    return (float(least / (x[1].sum() + rest_x[0] + y[1].sum() + rest_y[0] - least)),
            len(i) / (len(x[0]) + rest_x[1] + len(y[0]) + rest_y[1] - len(i)))


class Texts:
    """The shared shingles of the rows of a group, their weights, and weight and number of all shingles of each row."""

    def __init__(self, weigher: Weigher, shared: list[bytes]) -> None:
        sets = [unkept(x) for x in shared]
        self.sizes = np.array([len(x[0]) for x in sets])
        self.ends = np.cumsum(self.sizes)
        found, n, df = (np.concatenate([x[i] for x in sets]) for i in range(3))
        self.weights = weigher.weights(found, n, df)
        distinct, self.places = np.unique(found, return_inverse=True)
        starts = self.ends - self.sizes
        self.heavy = np.add.reduceat(self.weights, starts) + [x[3][0] for x in sets]
        self.many = self.sizes + [x[3][1] for x in sets]
        self.mine = np.zeros(len(distinct))

    def similarities(self, at: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``similarity`` of a row with others, weighted and plain."""
        own = slice(self.ends[at] - self.sizes[at], self.ends[at])
        self.mine[self.places[own]] = self.weights[own]
        least, both = np.empty(len(others)), np.empty(len(others))
        parts = np.flatnonzero(np.diff((np.cumsum(self.sizes[others]) - 1) // COMPARED, prepend=-1))
        for a, z in zip(parts, [*parts[1:], len(others)], strict=True):
            sizes = self.sizes[others[a:z]]
            starts = np.cumsum(sizes) - sizes
            rows = np.repeat(self.ends[others[a:z]] - sizes - starts, sizes) + np.arange(sizes.sum())
            mine = self.mine[self.places[rows]]
            least[a:z] = np.add.reduceat(np.minimum(mine, self.weights[rows]), starts)
            both[a:z] = np.add.reduceat((mine > 0).astype(float), starts)
        self.mine[self.places[own]] = 0
        return least / (self.heavy[at] + self.heavy[others] - least), both / (self.many[at] + self.many[others] - both)


def joining(position: int, bands: np.ndarray, signs: np.ndarray, roots: np.ndarray, blocks: np.ndarray | None,
            texts: Texts) -> Iterator[tuple[int, int, float, float]]:
    """Near pairs of rows, at ``LEAST_SHARE`` or more, that join rows of different roots, and of different ``blocks`` if given.

    A pair is looked at in the first bucket that it shares, whose band is ``position``.
    """
    roots = roots.copy()
    for at in range(len(signs) - 1):
        apart = roots[at + 1 :] != roots[at]
        if blocks is not None:
            apart &= blocks[at + 1 :] != blocks[at]
        rest = at + 1 + np.flatnonzero(apart)
        rest = rest[(bands[rest] == bands[at]).argmax(1) == position]
        rest = rest[shares(signs[rest], signs[at]) >= LEAST_SHARE] if len(rest) else rest
        if not len(rest):
            continue
        weighted, plain = texts.similarities(at, rest)
        for k in np.flatnonzero(np.maximum(weighted, plain) >= SIMILARITY).tolist():
            if roots[rest[k]] != roots[at]:
                roots[roots == roots[rest[k]]] = roots[at]
                yield at, int(rest[k]), float(weighted[k]), float(plain[k])


def _linked(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in rows], pa.binary()), pa.array([x[1] for x in rows], pa.binary()),
         pa.array([x[2] for x in rows], pa.float64()), pa.array([x[3] for x in rows], pa.float64())],
        ["a", "b", "weighted", "plain"])


def _join_apart(weigher: Weigher) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Verified links within each group between what is not joined; the rows come sorted by group."""

    def made(across: bool, position: int, rows: list[list]) -> Iterator[pa.RecordBatch]:
        nodes, signs, bands, roots, blocks, shared = zip(*rows, strict=True)
        number = {r: i for i, r in enumerate(dict.fromkeys(roots))}
        if len(number) > 1:
            pairs = joining(position, np.array(bands), np.stack([np.frombuffer(s, "<u4") for s in signs]), np.array([number[r] for r in roots]),
                            np.array(blocks) if across else None, Texts(weigher, shared))
            found = [(*sorted((nodes[i], nodes[j])), weighted, plain) for i, j, weighted, plain in pairs]
            if found:
                yield _linked(found)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for b in batches:
            for *k, position, node, sign, bands, root, block, shared in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != key:
                    if len(rows) > 1:
                        yield from made(key[1] != key[2], at, rows)
                    key, at, rows = k, position, []
                rows.append([node, sign, bands, root, block, shared])
        if len(rows) > 1:
            yield from made(key[1] != key[2], at, rows)

    return run


def _verify(weigher: Weigher) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def weighed(shared: bytes) -> tuple:
        found, n, df, rest = unkept(shared)
        return (found, weigher.weights(found, n, df)), rest

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, None
        for b in batches:
            rows = []
            for a, other, shared_a, shared_b in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if a != now:
                    now, last = a, weighed(shared_a)
                x, rest = weighed(shared_b)
                rows.append((a, other, *similarity(last[0], x, last[1], rest)))
            yield _linked([x for x in rows if max(x[2:]) >= SIMILARITY])

    return run


def node_of(text: Column) -> Column:
    """The name of a text in the graph: half its SHA-256."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def near_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and the verified links (a, b, weighted, plain) between different texts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), node_of(F.col(text_col)).alias("node"))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    weigher = Weigher(size.n)
    bits = min(max(SLICE_BITS[0], (int(size.bytes or 0) // SLICE_BYTES).bit_length()), SLICE_BITS[1])
    id_kind = rows.schema["doc_id"].dataType
    dealt = StructType([StructField("batch", LongType()), StructField("doc_ids", ArrayType(id_kind)), StructField("nodes", ArrayType(BinaryType())),
                        StructField("texts", BinaryType())])
    chars = min(ASK_CHARS << bits, MOST_ASK_CHARS)
    batches = stored(spark, rows.select("doc_id", "node", "text").mapInArrow(_batched(chars, to_arrow_schema(dealt)), dealt), "batches")
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    texts = batches.select("batch", none("slice", "int"), "doc_ids", "nodes", "texts", none("shingles", "binary"), none("n", "binary"))
    known = exact_frequencies(batches, bits).select("batch", "slice", *[none(f.name, f.dataType) for f in dealt[1:]], "shingles", "n")
    given = known.unionByName(texts).repartition("batch").sortWithinPartitions("batch", F.col("slice").asc_nulls_last())
    schema = StructType([rows.schema["doc_id"], StructField("node", BinaryType()), StructField("bands", ArrayType(LongType())),
                         StructField("sign", BinaryType()), StructField("shared", BinaryType())])
    signed = stored(spark, given.mapInArrow(_signatures(weigher, bits), schema), "signs")
    release_shuffles(spark)  # of the requests and answers, the largest
    nodes = signed.where("bands is not null").groupBy("node").agg(F.first("bands").alias("bands"), F.first("sign").alias("sign"), F.first("shared").alias("shared"))
    nodes = stored(spark, nodes, "nodes")
    pair = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])
    links = stored(spark, _forests(nodes).mapInArrow(_links, pair).distinct(), "candidates")
    release_shuffles(spark)
    near = _verified(nodes, links, weigher)
    release_shuffles(spark)
    roots = components(near)
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    more = stored(spark, _apart(nodes).mapInArrow(_join_apart(weigher), near.schema), "joined")
    return signed.select("doc_id", "node"), near.unionByName(more)


def _forests(nodes: DataFrame) -> DataFrame:
    """All buckets of more than one text (key, i, node, sign), by groups of a block and the next."""
    members = nodes.select(F.explode("bands").alias("key"), "node")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), n_blocks).cast("int")
    met = F.when(n_blocks <= 2, F.array(F.lit(0))).otherwise(F.array(own, F.pmod(own - 1, n_blocks)))
    members = members.join(shared, "key").select("key", F.explode(met).alias("i"), "node").join(nodes.select("node", "sign"), "node")
    return members.select("key", "i", "node", "sign").repartition("key", "i").sortWithinPartitions("key", "i", "node")


def _apart(nodes: DataFrame) -> DataFrame:
    """The buckets whose texts are of several roots, by groups of one or two blocks.

    Texts of the largest root of a bucket are joined already: their blocks meet
    those of all others, not each other. Of buckets with the same texts, that
    of the first band is enough.
    """
    members = nodes.select(F.posexplode("bands").alias("position", "key"), "node", "root", F.octet_length("shared").cast("long").alias("bytes"))
    mark = F.xxhash64("node")
    by_root = members.groupBy("key", "root").agg(
        F.min("position").alias("position"), F.count("*").alias("n"), F.sum("bytes").alias("bytes"),
        F.sum(mark.cast("decimal(38,0)")).alias("total"), F.bit_xor(mark).alias("mixed"))
    buckets = by_root.groupBy("key").agg(
        F.min("position").alias("position"), F.count("*").alias("roots"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
        F.sum("total").alias("total"), F.bit_xor("mixed").alias("mixed"), F.max(F.struct("n", "bytes", "root")).alias("main")).where("roots > 1")
    buckets = buckets.groupBy("n", "total", "mixed").agg(F.min(F.struct("position", "key", "bytes", "main")).alias("b")).select("n", "b.*")
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES)).cast("int")
    whole = (F.col("n") <= 2 * BLOCK) & (F.col("bytes") <= 2 * BLOCK_BYTES)
    buckets = buckets.select("key", "position", F.col("main.root").alias("main"), *[
        F.when(whole, F.lit(least)).otherwise(x).alias(name) for name, least, x in (
            ("others", 1, blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes"))),
            ("mains", 0, blocks(F.col("main.n"), F.col("main.bytes"))))])
    members = members.select("key", "node", "root").join(buckets, "key")
    of_main = (F.col("root") == F.col("main")) & (F.col("mains") > 0)
    own = F.when(of_main, F.col("others") + F.pmod(mark, F.col("mains"))).otherwise(F.pmod(mark, F.col("others"))).cast("int")
    members = members.withColumn("block", own).withColumn("met", F.explode(
        F.sequence(F.lit(0), F.when(of_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1)))
    members = members.select("key", F.least("block", "met").alias("i"), F.greatest("block", "met").alias("j"), "position", "node", "block")
    members = members.join(nodes, "node").select("key", "i", "j", "position", "node", "sign", "bands", "root", "block", "shared")
    return members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")


def _verified(nodes: DataFrame, links: DataFrame, weigher: Weigher) -> DataFrame:
    """The links (a, b, weighted, plain) that are near by the shingles in ``nodes``."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("shared").alias(f"shared_{x}"))
    both = links.join(side("b"), "b").join(side("a"), "a").select("a", "b", "shared_a", "shared_b")
    result = StructType([*links.schema, StructField("weighted", DoubleType()), StructField("plain", DoubleType())])
    return stored(links.sparkSession, both.mapInArrow(_verify(weigher), result), "near")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, kept, n_links and text_sha (half the text's SHA-256) of every row.

    ``class_id`` is the smallest id of the class, and the row that bears it is
    kept; of different texts that bear it, or of a class without ids, one. ``n_links`` counts the verified links of its text to other texts:
    links of a forest in each bucket, not all near pairs.
    Equal texts are of one class; NULL counts as the empty text, and a text
    without words is near to its copies alone. Rows without an id come last in
    the choice of ``class_id``. Of rows that repeat both id and text all are
    marked as kept. Other columns are left out; an empty table gives no rows.
    """
    rows, links = near_links(docs, id_col, text_col)
    roots = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    marked = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = marked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")).alias("first"))
    first = first.select("root", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("class_node"))
    out = marked.join(first, "root").join(degree, "node", "left")
    return out.select("doc_id", "class_id", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node"))).alias("kept"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.hex("node").alias("text_sha"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of near duplicates, with all its columns."""
    kept = near_groups(docs, id_col, text_col).where("kept").select("doc_id", F.lower("text_sha").alias("sha"))
    return keep_rows(docs, kept, id_col, text_col)


def op6_weighted_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates of all documents."""
    return near_groups(documents(spark, sf_dir))
