import zlib
from collections import Counter, defaultdict

from backdrop.llm import sharding as S
from pyspark.sql import functions as F

from tests.llm.conftest import row


def test_awkward_rows(docs, empty):
    out = S.shard_documents(docs, S.balanced_tree(16)).collect()
    assert len(out) == docs.count()
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    one = next(r for r in out if r.doc_id == 1)
    assert (one["size"], one.text_crc32) == (1, 0)
    assert next(r for r in out if r.doc_id == 9).text_crc32 == zlib.crc32(b"one")
    assert len({r.shard for r in out if r.doc_id == 6}) == 1
    assert S.shard_documents(empty, S.balanced_tree(16)).count() == 0


def test_growth_moves_rows_only_into_the_new_shard(spark):
    rows = spark.range(20_000)
    for n in (1, 5, 16, 17):
        tree = S.balanced_tree(n)
        moved = rows.select(S.shard_of(F.col("id"), tree).alias("a"), S.shard_of(F.col("id"), S.grown(tree)).alias("b")).collect()
        assert {r.b for r in moved if r.a != r.b} == {n}
        assert 0.6 * 20_000 / (n + 1) < sum(r.a != r.b for r in moved) < 1.5 * 20_000 / (n + 1)


def test_weights_and_confined_movement(spark):
    tree = S.balanced_tree(16)
    heavy = {g: {k: dict(s) for k, s in racks.items()} for g, racks in tree.items()}
    heavy["region1"]["rack2"][9] = 3.0
    rows = spark.range(40_000).select(S.shard_of(F.col("id"), tree).alias("a"), S.shard_of(F.col("id"), heavy).alias("b")).collect()
    n = Counter(r.b for r in rows)
    assert abs(n[9] / 40_000 - 3 / 18) < 0.015 and abs(n[0] / 40_000 - 1 / 18) < 0.01
    region = lambda s: s // 8
    assert all(region(r.b) == 1 for r in rows if r.a != r.b)  # rows enter the changed region only
    inside = [r for r in rows if region(r.a) == 1 and r.a != r.b]
    assert all(r.b // 4 == 2 for r in inside)  # within it, the changed rack only
    assert all(r.b == 9 for r in inside if r.a // 4 == 2)  # within that, the changed shard only


def test_one_repeated_id_is_numbered_in_blocks(table):
    out = S.shard_documents(table([row(7, f"t{i % 3}") for i in range(3000)]), S.balanced_tree(16))
    assert sorted(r.slot for r in out.collect()) == list(range(3000))
