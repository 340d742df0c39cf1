"""Fill-in-middle transformation with a Fenwick tree over blocks of the text.

A text is a row of blocks of ``BLOCK_CHARS`` code points. A Fenwick tree over
the blocks stores how many units (lines) end in each and how many code points
each holds. A cut after k units is found by a binary-lifting descent: it
steps over as many whole blocks as hold fewer than k unit ends and sums their
code points on the way; the boundary is then searched for in the next block
alone. Building the tree reads the text once; a cut costs a logarithm of the
number of blocks and one block.

A text without a transformation is ``plain``. Otherwise it is written as
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``), each part
after its sentinel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from backdrop.llm.common import bounded_batches, documents, texts_of
from backdrop.llm.words import groups

BLOCK_CHARS = 4096


class UnitTree:
    """Where a text can be cut: after any number of its lines (``[^\\n]*\\n|[^\\n]+``)."""

    def __init__(self, text: str, block: int = BLOCK_CHARS) -> None:
        self.text = text
        starts = range(0, len(text), block)
        self.blocks = len(starts)
        tree = np.zeros((self.blocks + 1, 2), np.int64)  # unit ends, code points
        tree[1:, 0] = [text.count("\n", s, s + block) for s in starts]
        tree[1:, 1] = [min(block, len(text) - s) for s in starts]
        if text and text[-1] != "\n":
            tree[-1, 0] += 1  # the last line ends with the text
        self.n = int(tree[:, 0].sum())
        # A node is done when its children, at smaller places, have been added to it.
        step = 1
        while step <= self.blocks:
            parents = np.arange(2 * step, self.blocks + 1, 2 * step)
            tree[parents] += tree[parents - step]
            step *= 2
        self.tree = tree.tolist()

    def end_of(self, k: int) -> int:
        """Code points before the cut after ``k`` units, 0 <= k <= n."""
        if k <= 0:
            return 0
        at, chars, left = 0, 0, k
        for bit in range(self.blocks.bit_length() - 1, -1, -1):
            to = at + (1 << bit)
            if to <= self.blocks and self.tree[to][0] < left:
                at = to
                left -= self.tree[to][0]
                chars += self.tree[to][1]
        for _ in range(left):
            found = self.text.find("\n", chars)
            if found < 0:
                return len(self.text)
            chars = found + 1
        return chars


@dataclass(frozen=True)
class Rule:
    """Sentinels, how many of 100 texts are changed, how many of 100 of these are ``spm``, and the seed of the draws."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    rate: int = 100
    spm_rate: int = 50
    seed: str = "7:"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or not all(marks):
            raise ValueError("the three sentinels must differ and not be empty")
        # Else a sentinel could arise where a part of the text meets a sentinel, and the text could not be rebuilt.
        for a in marks:
            for b in marks:
                if (a != b and b in a) or any(b.startswith(a[i:]) for i in range(1, len(a))):
                    raise ValueError(f"sentinels {a!r} and {b!r} overlap")


def transform(text: str, doc_id: str, rule: Rule) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars and output of one text."""
    tree = UnitTree(text)
    drawn = hashlib.sha256((rule.seed + doc_id).encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or h3 % 100 >= rule.rate or any(mark in text for mark in (rule.prefix, rule.suffix, rule.middle)):
        return tree.n, "plain", None, None, text
    first, last = sorted((h1 % (tree.n + 1), h2 % (tree.n + 1)))
    a, b = tree.end_of(first), tree.end_of(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < rule.spm_rate:
        return tree.n, "spm", a, b - a, "".join((rule.suffix, suffix, rule.prefix, prefix, rule.middle, middle))
    return tree.n, "psm", a, b - a, "".join((rule.prefix, prefix, rule.suffix, suffix, rule.middle, middle))


def _transform(rule: Rule) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b.column(2))
            keys = b.column(1).to_pylist()
            for part in groups(texts):
                made = [transform(t, k or "", rule) for t, k in zip(texts[part], keys[part], strict=True)]
                n, form, prefix, middle, output = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(part.start, len(made)), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row.

    The id alone decides the draws, so rows that repeat an id draw alike; a
    NULL id draws as the empty string. A NULL text counts as empty; an empty
    text, and one that holds a sentinel, stays ``plain`` with NULL lengths. A
    text is handled in memory whole, however long, beside one tree of its
    blocks. Other columns are left out; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("n", LongType()),
                         StructField("form", StringType()), StructField("prefix_chars", LongType()),
                         StructField("middle_chars", LongType()), StructField("output", StringType())])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_transform(rule or Rule()), schema)


def restored(output: Column, form: Column, rule: Rule | None = None) -> Column:
    """The text that was transformed, from its output and form alone; no sentinel occurs in its parts."""
    rule = rule or Rule()

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        body = F.substring(body, F.length(one) + len(second) + 1, F.length(output))
        two = F.substring_index(body, rule.middle, 1)
        return one, two, F.substring(body, F.length(two) + len(rule.middle) + 1, F.length(output))

    prefix, suffix, middle = parts(rule.prefix, rule.suffix)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(rule.suffix, rule.prefix)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fenwick_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed, and rebuilt from what came out."""
    made = fill_in_middle(documents(spark, sf_dir))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE_SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
    SELECT doc_id, t, string_split(t, chr(10)) AS parts,
           CAST(len(string_split(t, chr(10))) - (CASE WHEN t = '' OR suffix(t, chr(10)) THEN 1 ELSE 0 END) AS BIGINT) AS n,
           CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM u
), e AS (
    SELECT *, CASE WHEN a = n THEN t WHEN a = 0 THEN '' ELSE array_to_string(parts[1:a], chr(10)) || chr(10) END AS p,
           CASE WHEN b = n THEN t WHEN b = 0 THEN '' ELSE array_to_string(parts[1:b], chr(10)) || chr(10) END AS pm FROM c
), f AS (
    SELECT doc_id, n, form, t, p, substr(pm, length(p) + 1) AS m, substr(t, length(pm) + 1) AS s FROM e
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
