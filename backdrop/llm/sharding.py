"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks and shards. A row descends it: at every level each
child draws ``-ln(u) / weight`` with ``u`` a hash of the row's key and the
child's name, and the smallest draw wins (weighted rendezvous hashing), so a
child is chosen in proportion to its weight, which is the sum of the weights
of its shards. A draw depends on the key, the child's name and its weight
alone: when a weight changes, only draws of the nodes above that shard change,
and rows move only into (or, for a lower weight, out of) the subtrees whose
weight changed.

A shard added by :func:`grown` is a region of its own. No other draw changes,
so it takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from backdrop.llm.common import documents, stored

# region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]

RACKS_PER_REGION = 2
SHARDS_PER_RACK = 4
# Slots of a shard are given out in so many blocks of rows.
SLOT_BLOCKS = 1024
_UNIT = 1 << 53


def balanced_tree(n_shards: int) -> Tree:
    """Shards 0 to ``n_shards - 1`` of weight 1, racked in order."""
    if n_shards < 1:
        raise ValueError("a tree needs at least one shard")
    tree: Tree = {}
    for shard in range(n_shards):
        rack, region = shard // SHARDS_PER_RACK, shard // (SHARDS_PER_RACK * RACKS_PER_REGION)
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, as a region of its own."""
    shard = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"region+{shard}": {f"rack+{shard}": {shard: weight}}}


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.pmod(F.xxhash64(key, F.lit(name)), F.lit(_UNIT)).cast("double") + F.lit(0.5)) / F.lit(float(_UNIT))
    return -F.log(u) / F.lit(float(weight))


def _choose(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the smallest draw; children of weight 0 get nothing."""
    children = [c for c in children if c[1] > 0]
    if len(children) == 1:
        return children[0][2]
    draws = F.array(*[F.struct(_draw(key, name, w).alias("d"), F.lit(i).alias("i")) for i, (name, w, _) in enumerate(children)])
    won = F.array_min(draws)["i"]
    out = children[-1][2]
    for i in range(len(children) - 2, -1, -1):
        out = F.when(won == i, children[i][2]).otherwise(out)
    return out


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard that ``key`` descends to."""
    regions = []
    for region, racks in tree.items():
        of_region = []
        for rack, shards in racks.items():
            leaves = [(f"{region}/{rack}/{s}", w, F.lit(s)) for s, w in shards.items()]
            of_region.append((f"{region}/{rack}", sum(shards.values()), _choose(key, leaves)))
        regions.append((region, sum(w for _, w, _ in of_region), _choose(key, of_region)))
    if sum(w for _, w, _ in regions) <= 0:
        raise ValueError("a tree needs a shard with a weight over 0")
    return _choose(key, regions)


def shard_documents(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A shard and a slot for every row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: the id and the tree decide; equal texts under
    different ids go separate ways. Rows that repeat an id share its shard. A
    row without an id is keyed by the CRC of its text instead, so such rows
    spread. A NULL text has size 1 and the CRC of the empty text. Slots number
    a shard's rows from 0 without gaps: rows are dealt into ``SLOT_BLOCKS``
    blocks a shard, which are counted first and numbered apart, so no shard,
    however large, and no repeated id is numbered in one task. Other columns
    are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("bytes"),
                       F.crc32(text).alias("text_crc32"), F.col(text_col).isNull().alias("none"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("crc:"), F.col("text_crc32").cast("string")))
    rows = rows.withColumn("key", key).select(
        "doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32",
        shard_of(F.col("key"), tree).cast("int").alias("shard"),
        shard_of(F.col("key"), grown(tree)).cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"))
    rows = stored(spark, rows, "shards").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(SLOT_BLOCKS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "block").count().select(
        "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "row")) - 1
    # At most shards x SLOT_BLOCKS rows, whatever the input.
    return rows.withColumn("within", within).join(F.broadcast(starts), ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("within")).cast("long").alias("slot"), "grown_shard")


def op1_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15."""
    return shard_documents(documents(spark, sf_dir), balanced_tree(16))
