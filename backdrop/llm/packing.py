"""Best-fit packing of documents into sequences by bin completion.

Documents are encoded and cut into pieces in Arrow functions; only a piece's
length and digest leave them (its ids too, if asked for). Spark counts the
pieces of each length, at most ``capacity`` numbers whatever the corpus, and
:mod:`backdrop.llm.bin_completion` turns them into patterns: so many
sequences of these lengths. Spark numbers the pieces of each length from 0,
and a piece's number names its pattern, its sequence and its place there.

Pieces of one length may be a third of all: they are dealt into
``RANK_BLOCKS`` blocks, which are counted first and numbered apart.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from backdrop.llm import bin_completion, tokens
from backdrop.llm.common import arrow_type, bounded_batches, documents, kept_by_worker, stored, texts_of
from backdrop.llm.words import groups

CAPACITY = 2048
END_ID = 0
RANK_BLOCKS = 1024
# Small letters up to U+024F.
_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder(tokens.PieceMemo):
    """Ids of whole texts under a tokenizer that drops white space, from remembered words.

    No token, special ones included, holds white space, so the ids of a text
    are those of its words in a row. A word's final full stops and commas
    after a letter or digit are words too: letters, digits and other signs
    never share a token. In ASCII, case doesn't matter but in special strings.

    A word of Latin letters alone is one pre-token, whose normal form is its
    lower case: it goes to the model at once. All others go through the whole
    tokenizer.
    """

    def __init__(self, tokenizer_json: str) -> None:
        super().__init__()
        self.tokenizer = tokens.plain_tokenizer(tokenizer_json)
        self.model = self.tokenizer.model
        self.special = [t["content"] for t in json.loads(tokenizer_json)["added_tokens"]]
        symbol = {b: c for c, b in tokens.byte_symbols().items()}
        self.symbols = {c: "".join(symbol[b] for b in chr(c).encode()) for c in range(0x80, 0x250)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the words of short texts are looked up together."""
        out: list[np.ndarray] = []
        for some in groups(texts, tokens.SLICE_CHARS):
            if some.stop - some.start > 1:
                out += self._ids_of(texts[some])
            else:
                parts = [self._ids_of([part])[0] for part in tokens.slices(texts[some.start])]
                out.append(np.concatenate(parts) if parts else np.empty(0, "<u4"))
        return out

    def _ids_of(self, texts: list[str]) -> list[np.ndarray]:
        split = []
        for text in texts:
            low = text.lower() if text.isascii() else text
            split.append(tokens.words(text if any(x in low for x in self.special) else low))
        ids = self.learn(chain.from_iterable(split))
        return [np.frombuffer(b"".join(map(ids.__getitem__, words)), "<u4") for words in split]

    def _encode(self, new: list[str]) -> dict[str, bytes]:
        stems: dict[str, tuple[str, str]] = {}
        plain: dict[str, None] = {}
        for w in new:
            if w[-1] in ".,":
                stem = w.rstrip(".,")
                # Letters that both Python and the tokenizer know as such; others keep what follows.
                if stem and stem[-1] <= "ɏ" and stem[-1].lower()[-1].isalnum():
                    stems[w] = stem, w[len(stem) :]
                    plain.update(dict.fromkeys(stems[w]))
                    continue
            plain[w] = None
        known = {p: self.memo[p] for p in plain if p in self.memo}
        rest: list[str] = []
        for p in plain:
            if p in known:
                continue
            low = p.lower()
            if _LATIN.fullmatch(low):
                word = low if low.isascii() else low.translate(self.symbols)
                known[p] = array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
            else:
                rest.append(p)
        made = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        known.update((p, array("I", e.ids).tobytes()) for p, e in zip(rest, made, strict=True))
        known.update((w, known[a] + known[b]) for w, (a, b) in stems.items())
        return known


def _cut(spec: str, capacity: int, end_id: int, with_ids: bool, id_type: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("words", hash(spec)), lambda: WordEncoder(spec))
        end = np.array([end_id], "<u4")
        for b in batches:
            texts = texts_of(b.column(1))
            for part in groups(texts):
                rows: list[tuple] = []
                for i, ids in enumerate(encoder.encode(texts[part]), part.start):
                    ids = np.concatenate([ids, end])
                    for k, s in enumerate(range(0, len(ids), capacity)):
                        raw = ids[s : s + capacity].tobytes()
                        rows.append((i, k, s, len(raw) // 4, zlib.crc32(raw), raw if with_ids else None))
                at, *rest, raws = zip(*rows, strict=True)
                arrays = [b.column(0).take(pa.array(at)).cast(id_type), *(pa.array(x, t) for x, t in zip(rest, (pa.int32(), *[pa.int64()] * 3), strict=True))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(raws, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _entries(patterns: list[bin_completion.Pattern]) -> np.ndarray:
    """Where the pieces of each length go: length, first number, first sequence, pieces in a sequence, offset of the first."""
    rows, sequence, given = [], 0, {}
    for bins, held in patterns:
        offset = 0
        for length, k in held:
            rows.append((length, given.get(length, 0), sequence, k, offset))
            given[length] = given.get(length, 0) + bins * k
            offset += length * k
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(table: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last two columns, length and number, become sequence_id and offset."""
    # A length's numbers stay below 2 ** 50.
    keys = (table[:, 0] << 50) + table[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = (np.asarray(b.column(b.num_columns - k)) for k in (2, 1))
            row = table[np.searchsorted(keys, (length << 50) + number, "right") - 1]
            bin_, nth = np.divmod(number - row[:, 1], row[:, 3])
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(row[:, 2] + bin_), pa.array(row[:, 4] + nth * length)],
                                             [*b.schema.names[:-2], "sequence_id", "offset"])

    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """``number``: the pieces of each length from 0 without gaps."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(RANK_BLOCKS)).cast("int"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # At most capacity x RANK_BLOCKS rows; joined on the key that the numbering is dealt by.
    starts = rows.groupBy("length", "block").count().select(
        F.col("length").alias("l"), F.col("block").alias("b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "block").orderBy("row")) - 1
    same: Column = (F.col("length") == F.col("l")) & (F.col("block") == F.col("b"))
    return rows.withColumn("within", within).join(starts, same).withColumn("number", F.col("first") + F.col("within"))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, with_ids: bool = False, nodes: int = bin_completion.SEARCH_NODES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, unsigned 32-bit little-endian).

    A document is its ids and ``end_id``; only one longer than ``capacity``
    is cut, into pieces of ``capacity`` and a last one that may be shorter.
    NULL and empty texts are the end id alone. Rows that repeat an id are
    documents of their own; a NULL id is kept. A very long text is encoded in
    slices. Other columns are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType
    fields = [StructField("doc_id", kind), StructField("piece", IntegerType()), StructField("start", LongType()),
              StructField("length", LongType()), StructField("ids_crc32", LongType())]
    ids = [StructField("ids", BinaryType())] if with_ids else []
    cut = _cut(tokens.tokenizer_text(tokenizer_path), capacity, end_id, with_ids, arrow_type(kind))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, StructType(fields + ids))
    rows = stored(spark, rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    # Bounded like the counts: a pattern has at most sqrt(2 x capacity) lengths, and best fit makes at most 3 groups of bins a length.
    table = _entries(bin_completion.solve(counts, nodes))
    names = [f.name for f in fields + ids]
    out = StructType([*fields, *ids, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    numbered = _numbered(rows).select(*names, F.col("length").alias("l"), "number")
    return numbered.mapInArrow(_place(table), out)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence, from the pieces with their ids; a sequence has at most ``capacity`` of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def op13_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most ``CAPACITY`` tokens."""
    return pack_documents(documents(spark, sf_dir), default_path())
