"""Personal data, and the terms that give it away.

E-mail addresses, IP addresses, card and telephone numbers are found by
pattern; they are the protected entities. Terms of the documents that mention
an entity are weighed by what they tell about it: with probabilities over
documents, ``PMI(term; entity) = ln(p(term, entity) / (p(term) p(entity)))``
is compared with the entity's own information ``IC = -ln p(entity)``. The
ratio is the share of the entity that the term discloses, 1 if the term stands
nowhere else. Terms at ``GENERALISE_AT`` or more are generalised, at
``REMOVE_AT`` or more removed, wherever they stand, in documents without a
mention too.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from backdrop.llm.common import bounded_batches, documents, stored, texts_of

# Different texts in which term and entity must meet: fewer say nothing about the corpus. An entity
# of two texts has terms that stand in both; a single text does not tell its terms apart.
MIN_TEXTS = 3
LEAST_TEXTS = 2
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
# Bits of the filter that says which terms to count: 512 KiB.
FILTER_BITS = 22

# Kinds in their order and the patterns of the contract. Only
# places where a match can start are tried, so long runs take linear time.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end(), "email"
            last = m.end()
        at = text.find("@", max(at + 1, last))


def find_entities(text: str) -> list[Span]:
    """Spans of all kinds, by start and then by kind."""
    found = list(_emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def entity_of(text: str, span: Span) -> str:
    """The entity that a span mentions: its kind, and what of its spelling matters."""
    said = text[span[0] : span[1]]
    return f"{span[2]}:{said.lower()}" if span[2] == "email" else f"{span[2]}:" + re.sub(r"[^0-9.]" if span[2] == "ip" else r"[^0-9]", "", said)


def terms_outside(text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words of a text, words that touch a mention left out."""
    ends: list[int] = []  # the furthest end of the mentions so far
    for _, e in sorted(spans):
        ends.append(max(e, ends[-1] if ends else 0))
    starts = sorted(s for s, _ in spans)
    for m in _WORD.finditer(text):
        i = bisect_left(starts, m.end())
        if not i or ends[i - 1] <= m.start():
            yield m[0].lower(), *m.span()


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])


def _detect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds spans, their digest and the entities that they mention."""
    for b in batches:
        texts = texts_of(b.column(2))
        spans = [find_entities(t) for t in texts]
        said = [hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in x).encode()).hexdigest() for x in spans]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(3), b.column(2),
             pa.array([[dict(zip(("start", "end", "kind"), x, strict=True)) for x in s] for s in spans], pa.list_(_SPAN)),
             pa.array(said, pa.string()),
             pa.array([sorted({entity_of(t, x) for x in s}) for t, s in zip(texts, spans, strict=True)], pa.list_(pa.string()))],
            ["doc_id", "row", "text_hash", "text", "base", "base_sha256", "entities"])


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different terms of each text."""
    for b in batches:
        spans = [[(x["start"], x["end"]) for x in s] for s in b.column(3).to_pylist()]
        terms = [sorted({x[0] for x in terms_outside(t, s)}) for t, s in zip(texts_of(b.column(2)), spans, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(terms, pa.list_(pa.string()))], ["copies", "entities", "terms"])


def _places(wanted: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(row, term, start, end) of every place of a wanted term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted).tobytes()
        for b in batches:
            out: list[tuple[int, str, int, int]] = []
            if wanted.any():
                for row, text, base in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2).to_pylist(), strict=True):
                    out += [(row, *x) for x in terms_outside(text, [(y["start"], y["end"]) for y in base]) if bits[_slot(x[0])]]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                             ["row", "term", "start", "end"])

    return run


def _slot(term: str) -> int:
    return zlib.crc32(term.encode()) & ((1 << FILTER_BITS) - 1)


def _count_terms(wanted: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents that hold a wanted term, counted per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted).tobytes()
        for b in batches:
            total: Counter = Counter()
            if wanted.any():
                for text in texts_of(b.column(0)):
                    total.update(t for t in {x.lower() for x in _WORD.findall(text)} if bits[_slot(t)])
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "n"])

    return run


def _wanted(terms: DataFrame) -> np.ndarray:
    """The filter of a table of terms: at most 2 ** FILTER_BITS numbers reach the driver, whatever the corpus."""
    slots = terms.select((F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))).cast("int").alias("slot"))
    wanted = np.zeros(1 << FILTER_BITS, bool)
    wanted[slots.distinct().toPandas()["slot"].to_numpy(np.int64)] = True
    return np.packbits(wanted)


def disclosing_terms(found: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the terms that disclose ``GENERALISE_AT`` of an entity or more, over whole documents."""
    spark = found.sparkSession
    n_docs = found.count()
    texts = found.where(F.size("entities") > 0).groupBy("text_hash").agg(
        F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("text").alias("text"), F.first("base").alias("base"))
    texts = stored(spark, texts, "pii-texts")
    said = texts.select("text_hash", "copies", F.explode("entities").alias("entity"))
    of_entity = said.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("n_texts"))
    # An entity in every document carries no information: nothing discloses it.
    of_entity = of_entity.where((F.col("n_texts") >= LEAST_TEXTS) & (F.col("n_entity") < n_docs))
    of_entity = stored(spark, of_entity.select("entity", "n_entity", F.least("n_texts", F.lit(MIN_TEXTS)).alias("need")), "pii-entities")
    whom = said.join(of_entity, "entity", "left_semi").groupBy("text_hash").agg(F.collect_list("entity").alias("entities"))
    schema = StructType([StructField("copies", LongType()), StructField("entities", ArrayType(StringType())), StructField("terms", ArrayType(StringType()))])
    held = texts.drop("entities").join(whom, "text_hash").select("copies", "entities", "text", "base").mapInArrow(_terms, schema)
    pairs = held.select("copies", F.explode("entities").alias("entity"), "terms").select("copies", "entity", F.explode("terms").alias("term"))
    both = pairs.groupBy("entity", "term").agg(F.sum("copies").alias("n_both"), F.count("*").alias("n_texts"))
    both = stored(spark, both.join(of_entity, "entity").where(F.col("n_texts") >= F.col("need")), "pii-pairs")
    schema = StructType([StructField("term", StringType()), StructField("n", LongType())])
    counted = found.select("text").mapInArrow(_count_terms(_wanted(both)), schema).groupBy("term").agg(F.sum("n").alias("n_term"))
    share = F.log(F.col("n_both") * F.lit(float(n_docs)) / (F.col("n_term") * F.col("n_entity"))) / F.log(F.lit(float(n_docs)) / F.col("n_entity"))
    weighed = both.join(counted, "term").withColumn("disclosure", share)
    return weighed.where(F.col("disclosure") >= GENERALISE_AT).select("entity", "term", "disclosure")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every row: doc_id, text (only where something was found), base, base_sha256, terms.

    ``base`` has the entities as (start, end, kind) in code points, end
    exclusive; ``terms`` all places of disclosing terms as (start, end,
    disclosure), by the entity that a term discloses most. A text that is NULL
    or empty has none. Repeated rows count as documents each, but only
    different texts count towards ``MIN_TEXTS``. Other columns
    are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"))
    span = "array<struct<start: bigint, end: bigint, kind: string>>"
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("row", LongType()),
                         StructField("text_hash", LongType()), StructField("text", StringType()),
                         StructField("base", _type(span)), StructField("base_sha256", StringType()),
                         StructField("entities", ArrayType(StringType()))])
    found = stored(spark, rows.mapInArrow(_detect, schema), "pii-found")
    model = disclosing_terms(found).groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    model = stored(spark, model, "pii-terms")
    place = StructType.fromDDL("row bigint, term string, start bigint, end bigint")
    places = found.select("row", "text", "base").mapInArrow(_places(_wanted(model)), place)
    added = places.join(model, "term")
    added = added.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    out = found.join(added, "row", "left").withColumn("text", F.when((F.size("base") > 0) | F.col("terms").isNotNull(), F.col("text")))
    none = F.array().cast("array<struct<start: bigint, end: bigint, disclosure: double>>")
    return out.select("doc_id", "text", "base", "base_sha256", F.coalesce("terms", none).alias("terms"))


def _type(ddl: str) -> ArrayType:
    return StructType.fromDDL(f"x {ddl}")["x"].dataType


def _clean(text: str, base: list, terms: list) -> str:
    """The text without what was found: entities by kind, terms by their shape or not at all."""
    marks = [(x["start"], x["end"], f"[{x['kind'].upper()}]") for x in base]
    marks += [(x["start"], x["end"], "" if x["disclosure"] >= REMOVE_AT else
               "[NAME]" if text[x["start"]].isupper() else "[WORD]") for x in terms]
    out, last = [], 0
    for s, e, said in sorted(marks):
        if s >= last:
            out += [text[last:s], said]
        last = max(last, e)
    return "".join([*out, text[last:]])


def _sanitise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        base, terms = b.column(2).to_pylist(), b.column(3).to_pylist()
        made = [_clean(t, x, y) for t, x, y in zip(texts_of(b.column(1)), base, terms, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], ["doc_id", "sanitised"])


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and sanitised text of the rows in which something was found; all others may stay as they are."""
    found = personal_data(docs, id_col, text_col).where((F.size("base") > 0) | (F.size("terms") > 0))
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("sanitised", StringType())])
    return found.select("doc_id", "text", "base", "terms").mapInArrow(_sanitise, schema)


def op9_information_theoretic_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in all documents."""
    found = personal_data(documents(spark, sf_dir))
    base = F.transform("base", lambda x: F.struct(x.start.alias("s"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), x.kind).alias("o"),
                                                  F.concat_ws(":", x.kind, x.start, x.end).alias("t")))
    terms = F.transform("terms", lambda x: F.struct(x.start.alias("s"), F.lit(9).cast("bigint").alias("o"), F.concat_ws(":", F.lit("term"), x.start, x.end).alias("t")))
    spans = F.array_join(F.transform(F.sort_array(F.concat(base, terms)), lambda x: x.t), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], "base_sha256", spans.alias("spans"))
