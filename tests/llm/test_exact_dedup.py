import hashlib
from collections import defaultdict

import pytest
from backdrop.llm import exact_dedup as E
from pyspark.sql import functions as F

from tests.llm.conftest import awkward, prose, row


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    pick = max if keep == "largest" else min
    return {t: (pick((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_awkward_rows(docs, empty, keep):
    want = brute(awkward(), keep)
    out = E.exact_groups(docs, keep=keep).collect()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(out) == len(awkward())
    assert all((r.keep_id, r.group_size) == by_sha[r.text_sha256] for r in out)
    kept = [r for r in out if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(by_sha) and all(r.doc_id == r.keep_id for r in kept)
    assert E.exact_groups(empty).count() == 0


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_a_hot_group_spans_partitions(table, keep):
    rows = [row(i, prose(i % 2 and i, 6) if i % 3 else "hot text") for i in range(6000)]
    runs = E.exact_groups(table(rows).repartition(5), keep=keep)
    want = brute(rows, keep)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    out = runs.collect()
    assert all((r.keep_id, r.group_size) == by_sha[r.text_sha256] for r in out)
    assert sum(r.kept for r in out) == len(want)


def test_rows_that_stay(docs, empty):
    out = E.drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r.text or "" for r in out.collect()) == sorted({r[1] or "" for r in awkward()})
    assert E.drop_exact_copies(empty).count() == 0


def test_normalised_texts(table):
    out = E.exact_groups(table([row(1, "A b"), row(2, "a B"), row(3, None)]), normalise=F.lower).collect()
    assert {r.doc_id: r.keep_id for r in out} == {1: 1, 2: 1, 3: 3}
