"""BPE encoding and decoding with content-defined chunks.

A rolling hash over the bytes of a text cuts it into chunks. Where a cut falls
depends on the bytes just before it alone, so passages that documents share
fall into the same chunks, whatever stands around them. A task encodes each
distinct chunk once while it remembers it.

Ids at the rim of a chunk depend on what stands beside it. A join of two
chunks is repaired by re-encoding: the window that is encoded anew starts with
the text around the cut and grows to both sides, over whole chunks if need be,
until both its ends are safe boundaries (see ``tokens``), where the ids of the
chunk and those of the whole text must agree.

Decoding goes by a table of the bytes of each id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from backdrop.llm import tokens
from backdrop.llm.common import bounded_batches, documents, kept_by_worker, texts_of

# Bytes that decide a cut; a chunk has about 2 ** CHUNK_BITS bytes and at most CHUNK_MAX.
WINDOW = 16
CHUNK_BITS = 9
CHUNK_MAX = 1 << 16
# Bytes of chunks that a task remembers.
CACHE_BYTES = 32 << 20

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each byte (fewer at the start)."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:
        later = h.copy()
        later[step:] += h[:-step] << np.uint32(step)
        h = later
        step *= 2
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8; the last is the text's end."""
    n = len(data)
    if n == 0:
        return []
    raw = np.frombuffer(data, np.uint8)
    # A high bit of the hash has seen the whole window.
    found = np.flatnonzero((rolling_hash(raw)[WINDOW - 1 : -1] >> np.uint32(WINDOW - 1)) % np.uint32(1 << CHUNK_BITS) == 0) + WINDOW
    ends: list[int] = []
    last = 0
    for end in [*found.tolist(), n]:
        while end - last > CHUNK_MAX:
            far = last + CHUNK_MAX
            while data[far] & 0xC0 == 0x80:
                far -= 1
            ends.append(far)
            last = far
        while end < n and data[end] & 0xC0 == 0x80:
            end += 1
        if end > last:
            ends.append(end)
            last = end
    return ends


class ChunkEncoder:
    """Ids of whole texts from remembered chunks."""

    def __init__(self, tokenizer_json: str) -> None:
        self.encoder = tokens.PieceEncoder(tokenizer_json)
        self.chunks: dict[bytes, tuple[str, list[str], str] | None] = {}
        self.ids: dict[bytes, bytes] = {}
        self.held = 0

    def split(self, chunk: bytes) -> tuple[str, list[str], str] | None:
        """What stands before the first safe boundary, the pieces up to the last one, the rest; None without boundary."""
        text = chunk.decode()
        ends = tokens.safe_ends(text)
        return ends and (text[: ends[0]], tokens.pieces(text[ends[0] : ends[1]]), text[ends[1] :])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, equal to those of the tokenizer for the whole text.

        Long texts are worked on in slices between safe boundaries, so no more
        than a slice's pieces are alive at once.
        """
        out: list[np.ndarray] = []
        short: list[str] = []
        for text in texts:
            if len(text) <= tokens.SLICE_CHARS:
                short.append(text)
                continue
            out += self._encode(short)
            short = []
            out.append(np.concatenate([self._encode([part])[0] for part in tokens.slices(text)]))
        return out + self._encode(short)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > CACHE_BYTES:
            self.chunks.clear()
            self.ids.clear()
            self.held = 0
        plans: list[list[bytes | str]] = []
        wanted: list[str] = []
        new: list[bytes] = []
        for text in texts:
            plan: list[bytes | str] = []
            data, last, window = text.encode(), 0, []
            for end in cuts(data):
                chunk = data[last:end]
                last = end
                if chunk not in self.chunks:
                    self.chunks[chunk] = self.split(chunk)
                    self.held += 3 * len(chunk) + 300
                    new.append(chunk)
                at = self.chunks[chunk]
                if at is None:
                    window.append(chunk.decode())  # no boundary to agree at: the window grows over the chunk
                else:
                    plan += ["".join([*window, at[0]]), chunk]
                    window = [at[2]]
            plan.append("".join(window))
            plans.append(plan)
            wanted += [p for w in plan if isinstance(w, str) for p in tokens.pieces(w)]
        for chunk in new:
            if (at := self.chunks[chunk]) is not None:
                wanted += at[1]
        ids = self.encoder.learn(wanted)
        for chunk in new:
            if (at := self.chunks[chunk]) is not None:
                self.ids[chunk] = b"".join(map(ids.__getitem__, at[1]))
                self.chunks[chunk] = (at[0], [], at[2])
        return [np.frombuffer(b"".join(self.ids[w] if isinstance(w, bytes) else b"".join(map(ids.__getitem__, tokens.pieces(w)))
                                       for w in plan), "<u4") for plan in plans]


def _groups(texts: list[str], most: int = 1 << 18) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together."""
    group: list[str] = []
    held = 0
    for t in texts:
        if group and held + len(t) > most:
            yield group
            group, held = [], 0
        group.append(t)
        held += len(t)
    if group:
        yield group


def _encode(spec: str, digest: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("chunks", hash(spec)), lambda: ChunkEncoder(spec))
        decoder = encoder.encoder.decoder
        for b in batches:
            at = 0
            for texts in _groups(texts_of(b.column(b.num_columns - 1))):
                rest = [b.column(i).slice(at, len(texts)) for i in range(b.num_columns - 1)]
                at += len(texts)
                ids = encoder.encode(texts)
                back = (decoder.decode(x).decode(errors="replace") for x in ids)
                if digest:
                    made = [pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back])]
                else:
                    made = [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(list(back), pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array([len(x) for x in ids], pa.int64()), *made],
                    names=[f"r{i}" for i in range(len(rest))] + ["n", "a", "b"])

    return run


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digest: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text of every row.

    ``ids`` is binary, unsigned 32-bit little-endian. With ``digest`` their
    SHA-256 stand instead, as ids_sha256 and decoded_sha256. NULL counts as
    the empty text, which has no ids. Repeated rows are encoded each, a NULL
    id is kept; other columns are left out; an empty table gives no rows. A
    very long text is worked on in slices; a stretch without white space, be it
    the whole text, is encoded at once.
    """
    bounded_batches(docs.sparkSession)
    spec = tokens.tokenizer_text(tokenizer_path)
    made = [StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())] if digest else [
        StructField("ids", BinaryType()), StructField("decoded", StringType())]
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("n_tokens", LongType()), *made])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_named(_encode(spec, digest), [f.name for f in schema]), schema)


def _named(run: Callable, names: list[str]) -> Callable:
    return lambda batches: (pa.RecordBatch.from_arrays(b.columns, names=names) for b in run(batches))


def op2_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of all documents."""
    return encode_documents(documents(spark, sf_dir), tokens.default_path(), digest=True)
