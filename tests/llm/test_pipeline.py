import hashlib
import os

import corpus_pipeline as C
import numpy as np
import pytest
from backdrop.llm import decontamination as D
from backdrop.llm import tokens as T
from backdrop.llm import toxicity as X
from tokenizers import Tokenizer

from tests.llm.conftest import SCHEMA, awkward, prose, row
from tests.llm.test_decontamination import edit_distance
from tests.llm.test_near_dedup import classes, near_rows
from tests.llm.test_toxicity import make

ITEMS = [(i, prose(700 + i, 25)) for i in range(5)] + [(9, None)]


def corpus():
    texts, labels = make(11, 400)
    rows = [row(5000 + i, t) for i, t in enumerate(texts)] + near_rows() + awkward()
    rows += [row(9000 + i, f"{prose(800 + i, 40)} {t} {prose(900 + i, 10)}") for i, t in ITEMS if t]
    return rows, [(5000 + i, 1, y) for i, y in enumerate(labels)] + [(None, 1, 1), (1, None, None)]


@pytest.fixture()
def sf_dir(spark, tmp):
    rows, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(os.path.join(tmp, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp, "labels.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(os.path.join(tmp, "benchmark.parquet"))
    return tmp


def test_against_brute_force(spark, sf_dir):
    rows, _ = corpus()
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    net = X.learn(docs, spark.read.parquet(os.path.join(sf_dir, "labels.parquet")))
    kept = [r for r in rows if net.scores([r[1] or ""])[0] < 0.5]
    assert len(rows) - len(kept) >= 90  # a hundred rows are toxic
    one = {}
    for r in kept:  # the largest id of each text; no id comes last
        t = r[1] or ""
        if t not in one or (r[0] if r[0] is not None else -(1 << 62)) > (one[t][0] if one[t][0] is not None else -(1 << 62)):
            one[t] = r
    groups = classes(list(one.values()))
    unnamed = [r for r in one.values() if r[0] is None]
    kept = [r for r in one.values() if r[0] in groups] + unnamed
    items = [D.words_of(t) for _, t in ITEMS if t]
    kept = [r for r in kept if all(edit_distance(i, D.words_of(r[1] or "")) > int(len(i) * 0.2 + 1e-9) for i in items)]
    library = Tokenizer.from_file(T.default_path())
    want = []
    for r in kept:
        ids = np.array(library.encode(r[1] or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.append((str(r[0]), len(ids) // 4, ids, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in C.run(spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns_and_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).limit(0)
    for name, stage in C.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0, name
        if stage is not C.encode:
            assert out.columns == docs.columns, name
