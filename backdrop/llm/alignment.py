"""Cross-tokenizer alignment over distinct texts.

Rows are shuffled by their full text, counted on the way, so a text that many
documents share is tokenised and aligned once and carries its multiplicity.
Texts are worked on in blocks. A block knows its distinct linked id pairs and,
for each, how many documents of the block hold it; these counts are summed
over all blocks by Spark, and every block gets back the totals of its own
pairs only. Each text's measures are then summed up from its links and joined
to the ids of its documents by the text's digest.

Both tokenizers keep apart what a *safe boundary* parts (see ``tokens``; for
the second one, also no piece of its vocabulary may cross it). No group of
tokens crosses such a boundary either, so pieces between boundaries are
aligned once while they are remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from backdrop.llm import tokens
from backdrop.llm.common import bounded_batches, documents, kept_by_worker, stored, texts_of
from backdrop.llm.words import groups

# Characters of the texts of one block: a block asks once for each of its pairs.
BLOCK_CHARS = 1 << 22
# A text of more than one in so many rows is joined to its documents by broadcast; so many such texts there are at most.
HOT_TEXTS = 1000
# A pair of ids is one number: the first id above, the second in the lower bits.
PAIR_BITS = 32
# Estimated bytes of a remembered piece beside what was made of it.
ENTRY_BYTES = 340


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """A BPE model of the sentencepiece library with byte fallback: ids, and the bytes of each."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        table, crossing = [], set()
        white = re.compile(f"[{tokens.WHITE}▁]")
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                table.append(bytes([int(piece[3:5], 16)]))
                continue
            table.append(piece.replace("▁", " ").encode())
            crossing |= {b.replace("▁", " ") for a, b in zip(piece, piece[1:], strict=False) if white.match(b) and not white.match(a)}
        self.bytes = tokens.ByteTable(table)
        # White space that some piece holds after another character: no safe boundary lies before it.
        self.crossing = "".join(sorted(crossing))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text that begins with white space at a safe boundary, without the space that the model adds."""
        ids = self.model.encode("x" + text, num_threads=1)
        if self.bytes.decode(np.array(ids[:1])) != b" x":
            raise ValueError("this model adds no space, or joins letters with white space")
        return np.array(ids[1:], np.int64)


# n_a, n_b, n_groups, the groups as text, and the linked pairs as 64-bit numbers; None if the bytes of the tokens are not the text's.
Entry = tuple[int, int, int, str, bytes] | None


class Aligner(tokens.PieceMemo):
    """Aligned tokens of pieces of a text that begins with a space, special strings being plain text."""

    def __init__(self, tokenizer_json: str, model: bytes) -> None:
        super().__init__()
        self.a = tokens.PieceEncoder(tokenizer_json, special=False)
        self.b = PieceModel(model)
        white, bad = f"[{tokens.WHITE}]", re.escape(self.b.crossing)
        word = f"[^{tokens.WHITE}]"
        more = f"(?:[{bad}]{white}*{word}*)*" if bad else ""
        if " " in self.b.crossing:
            raise ValueError("this model joins words: there are no safe boundaries")
        self.piece = re.compile(f"{white}*{word}+{more}|{white}+")
        self.boundary = re.compile(f"{word}(?={white})" + (f"(?![{bad}])" if bad else ""))
        self.in_row = re.compile(f"{white}.*{word}", re.DOTALL)

    def _size(self, known: dict[str, Entry]) -> int:
        return ENTRY_BYTES * len(known) + sum(len(e[3]) + len(e[4]) for e in known.values() if e)

    def _encode(self, new: list[str]) -> dict[str, Entry]:
        rows: list[list[str]] = []
        held = tokens.ROW_CHARS
        for p in new:
            if not self.in_row.fullmatch(p):
                rows.append([p])
                held = tokens.ROW_CHARS
                continue
            if held + len(p) > tokens.ROW_CHARS:
                rows.append([])
                held = 0
            rows[-1].append(p)
            held += len(p)
        known: dict[str, Entry] = {}
        for row in rows:
            known.update(zip(row, self._align(row), strict=True))
        return known

    def _align(self, row: list[str]) -> list[Entry]:
        text = "".join(row)
        data = text.encode()
        a = np.array(self.a.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = self.b.encode(text)
        if self.a.decoder.decode(a) != data or self.b.bytes.decode(b) != data:
            return [None] if len(row) == 1 else [e for p in row for e in self._align([p])]
        a_ends, b_ends = np.cumsum(self.a.decoder.length[a]), np.cumsum(self.b.bytes.length[b])
        # Ends rise, and both end with the row.
        shared = a_ends[b_ends[np.searchsorted(b_ends, a_ends)] == a_ends]
        a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        a_from = np.searchsorted(a_group, np.arange(len(shared) + 1))
        b_from = np.searchsorted(b_group, np.arange(len(shared) + 1))
        # Every token of the first meets all of the second in its group.
        times = np.diff(b_from)[a_group]
        upto = np.cumsum(times)
        pairs = np.repeat(a << PAIR_BITS, times) | b[np.repeat(b_from[a_group] - (upto - times), times) + np.arange(upto[-1])]
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        parts = [f"{a_text[i]}|{b_text[k]}" if j - i == 1 == m - k else ",".join(a_text[i:j]) + "|" + ",".join(b_text[k:m])
                 for i, j, k, m in zip(a_from.tolist(), a_from[1:].tolist(), b_from.tolist(), b_from[1:].tolist(), strict=False)]
        # A piece ends where a group ends.
        want = np.cumsum([len(p.encode()) for p in row])
        end = np.searchsorted(shared, want)
        if not np.array_equal(shared[end], want):
            raise ValueError("a token crosses a safe boundary")
        last = [0, *(end + 1).tolist()]
        links = [0, *upto[a_from[end + 1] - 1].tolist()]
        a_at, b_at = a_from.tolist(), b_from.tolist()
        return [(a_at[j] - a_at[i], b_at[j] - b_at[i], j - i, ";".join(parts[i:j]), pairs[k:m].tobytes())
                for i, j, k, m in zip(last, last[1:], links, links[1:], strict=False)]

    def align(self, texts: list[str]) -> Iterator[tuple[int, int, int, list[str], np.ndarray]]:
        """n_a, n_b, n_groups, the groups in parts, and the linked pairs of each text in order; all zero if its bytes are not the tokens'."""
        for some in groups(texts, tokens.SLICE_CHARS):
            if some.stop - some.start > 1:
                split = [self.piece.findall(" " + t) if t else [] for t in texts[some]]
                yield from self._sum_up(split)
                continue
            whole = [0, 0, 0, [], []]
            for part in tokens.slices(" " + texts[some.start] if texts[some.start] else "", boundary=self.boundary):
                made = next(self._sum_up([self.piece.findall(part)]))
                if made[0] == 0:
                    whole = [0, 0, 0, [], []]
                    break
                whole = [*(x + y for x, y in zip(whole[:4], made[:4], strict=True)), [*whole[4], made[4]]]
            yield (*whole[:4], np.concatenate(whole[4]) if whole[4] else np.empty(0, np.int64))

    def _sum_up(self, split: list[list[str]]) -> Iterator[tuple[int, int, int, list[str], np.ndarray]]:
        pieces = dict.fromkeys(chain.from_iterable(split))
        made = self.learn(pieces)
        entries = list(map(made.__getitem__, pieces))
        distinct = dict(zip(pieces, range(len(pieces)), strict=True))
        good = np.array([e is not None for e in entries], bool)
        lines = [e[3] if e else "" for e in entries]
        counts = np.array([e[:3] if e else (0, 0, 0) for e in entries], np.int64).reshape(-1, 3)
        pool = np.frombuffer(b"".join(e[4] for e in entries if e), np.int64)
        size = np.array([len(e[4]) // 8 if e else 0 for e in entries], np.int64)
        start = np.cumsum(size) - size
        for found in split:
            at = np.fromiter(map(distinct.__getitem__, found), np.int64, len(found))
            if not len(at) or not good[at].all():
                yield 0, 0, 0, [], np.empty(0, np.int64)
                continue
            n = size[at]
            upto = np.cumsum(n)
            links = pool[np.repeat(start[at] - (upto - n), n) + np.arange(upto[-1])]
            n_a, n_b, n_groups = counts[at].sum(0).tolist()
            yield n_a, n_b, n_groups, list(map(lines.__getitem__, at.tolist())), links


_LISTS = [("sha", StringType()), ("documents", LongType()), ("n_a", LongType()), ("n_b", LongType()), ("n_groups", LongType()),
          ("groups", StringType()), ("n_pairs", LongType())]
_BLOCK = StructType([StructField("block", LongType()), StructField("pair", ArrayType(LongType())), StructField("held_by", ArrayType(LongType())),
                     *[StructField(n, ArrayType(t)) for n, t in _LISTS], StructField("links", BinaryType())])


def _blocks(spec: str, model: bytes, digest: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        # The table that the blocks are written to has them once, of whichever attempt.
        block = TaskContext.get().partitionId() << 32
        schema = to_arrow_schema(_BLOCK)
        held: list[list] = []
        chars = 0

        def close() -> pa.RecordBatch:
            nonlocal block, chars
            pairs = np.concatenate([r[-2] for r in held])
            times = np.concatenate([r[-1] for r in held])
            n_pairs = np.array([len(r[-2]) for r in held], np.int64)
            distinct, at = np.unique(pairs, return_inverse=True)
            weight = np.bincount(at, np.repeat([r[1] for r in held], n_pairs), len(distinct)).astype(np.int64)
            # A text's places among the block's pairs rise: steps compress better.
            step = np.diff(at, prepend=0)
            first = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
            step[first] = at[first]
            links = zstandard.ZstdCompressor(level=1).compress(step.astype("<u4").tobytes() + times.astype("<u4").tobytes())
            columns = [[block], [distinct], [weight], *([list(c)] for c in zip(*(r[:6] for r in held), strict=True)), [n_pairs], [links]]
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            block += 1
            held.clear()
            chars = 0
            return made

        for b in batches:
            aligner = kept_by_worker(("aligner", hash(spec), hash(model)), lambda: Aligner(spec, model))
            texts = texts_of(b.column(0))
            rows = zip(texts, b.column(1).to_pylist(), b.column(2).to_pylist(), aligner.align(texts), strict=True)
            for text, documents, sha, (n_a, n_b, n_groups, parts, links) in rows:
                if n_a:
                    distinct, times = np.unique(links, return_counts=True)
                    line = ";".join(parts)
                    held.append([sha, documents, n_a, n_b, n_groups, hashlib.sha256(line.encode()).hexdigest() if digest else line, distinct, times])
                    chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield close()
        if held:
            yield close()

    return run


def aligned_blocks(docs: DataFrame, tokenizer_path: str, model_path: str, text_col: str = "text", digest: bool = False) -> DataFrame:
    """A stored table of blocks of distinct texts, aligned: the texts' digests and groups, and their linked pairs.

    Texts without tokens (NULL, empty, or not equal to the bytes of their
    tokens) are in no block.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(model_path, "rb") as f:
        model = f.read()
    # Counted before the shuffle too, so copies of one text meet as one row a task.
    texts = docs.select(F.col(text_col).alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("n"))
    run = _blocks(tokens.tokenizer_text(tokenizer_path), model, digest)
    return stored(spark, texts.select("text", "n", F.sha2("text", 256).alias("sha")).mapInArrow(run, _BLOCK), "aligned")


def _asked(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.posexplode(F.arrays_zip("pair", "held_by")).alias("at", "asked")).select(
        "block", "at", F.col("asked.pair").alias("pair"), F.col("asked.held_by").alias("held_by"))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, a_id, b_id, documents, best: how many documents hold the pair linked, and whether that is the most of its a_id (ties included)."""
    total = _asked(blocks).groupBy("pair").agg(F.sum("held_by").alias("documents"))
    total = total.withColumn("a_id", F.shiftright("pair", PAIR_BITS)).withColumn("b_id", F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)))
    # An id has at most as many partners as the second vocabulary has ids.
    most = F.max("documents").over(Window.partitionBy("a_id"))
    return total.withColumn("best", F.col("documents") == most)


_MEASURES = StructType([StructField("sha", StringType()), StructField("documents", LongType()), *[StructField(c, LongType()) for c in (
    "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], StructField("groups", StringType())])


def _sum_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_MEASURES)
    for b in batches:
        rows = b.to_pydict()
        for i in range(b.num_rows):
            answers = b.column(b.schema.get_field_index("answers"))[i].values
            count, best = (np.zeros(len(answers), t) for t in (np.int64, bool))
            at = np.asarray(answers.field("at"))
            count[at], best[at] = np.asarray(answers.field("documents")), answers.field("best").to_numpy(zero_copy_only=False)
            n = np.array(rows["n_pairs"][i], np.int64)
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(rows["links"][i]), "<u4").astype(np.int64)
            step, times = np.split(raw, 2)
            ends = np.cumsum(n)
            sums = np.cumsum(step)
            place = sums - np.repeat(np.where(ends > n, sums[ends - n - 1], 0), n)
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])])
            columns = [rows[c][i] for c in ("sha", "documents", "n_a", "n_b", "n_groups")]
            columns += [total(times), total(times * best[place]), total(times * count[place]), rows["groups"][i]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_measures(blocks: DataFrame) -> DataFrame:
    """One row per distinct text of the blocks: sha, documents, n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    answers = _asked(blocks).join(pair_counts(blocks), "pair").groupBy("block").agg(F.collect_list(F.struct("at", "documents", "best")).alias("answers"))
    return blocks.drop("pair", "held_by").join(answers, "block").mapInArrow(_sum_links, _MEASURES)


def align_documents(docs: DataFrame, tokenizer_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                    digest: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every row.

    ``groups`` lists the groups as ``a1,a2|b1;a3|b2,b3``; with ``digest`` its
    SHA-256 stands instead, as groups_sha256. NULL and empty texts, and texts
    that are not the joined bytes of their tokens, have no tokens: zeros and an
    empty string. Rows that repeat an id or a text each count as a document; a
    NULL id is kept. A very long text is aligned in slices; a stretch without
    white space, be it the whole text, at once. Other columns are left out; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = aligned_blocks(docs, tokenizer_path, model_path, text_col, digest)
    made = stored(spark, text_measures(blocks), "measures")
    total = made.agg(F.sum("documents")).first()[0] or 0
    hot = F.col("documents") * HOT_TEXTS > total
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    measures = F.struct(*names)
    # Fewer than HOT_TEXTS rows.
    often = F.broadcast(made.where(hot).select(F.col("sha").alias("hot_sha"), measures.alias("hot")))
    rest = made.where(~hot).select(F.col("sha").alias("key"), measures.alias("cold"))
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.when(text != "", F.sha2(text, 256)).alias("sha"))
    rows = rows.join(often, rows.sha == often.hot_sha, "left")
    # Rows that need no partner are dealt out by their place.
    alone = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))
    rows = rows.withColumn("key", F.when(F.col("sha").isNull() | F.col("hot_sha").isNotNull(), alone).otherwise(F.col("sha")))
    got = rows.join(rest, "key", "left").select("doc_id", F.coalesce("hot", "cold").alias("m"))
    return got.select("doc_id", *[F.coalesce(F.col(f"m.{c}"), F.lit(0)).cast("long").alias(c) for c in names[:-1]],
                      F.coalesce("m.groups", F.lit("")).alias("groups_sha256" if digest else "groups"))


def op11_distinct_text_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level tokenizer with the piece tokenizer over all documents."""
    return align_documents(documents(spark, sf_dir), tokens.default_path(), default_path(), digest=True)
