import numpy as np
from backdrop.llm import language as L

from tests.conftest import SF_SMALL


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(out) > 150 and (out.lang_pred == out.lang).mean() > 0.98
    assert out.score.between(0, 1).all()


def test_against_explicit_vectors():
    bundler = L.Bundler(L.letter_table())
    text = "Hé, ab: a"
    base = np.random.default_rng(L.SEED).integers(0, 2, (L.LETTERS, L.DIMENSIONS), np.int8).astype(int) * 2 - 1
    base[0] = 1
    vector = lambda c: base[ord(c) % (L.LETTERS - 1) + 1 if c.isalpha() else 0]
    padded = " hé ab a "
    want = sum(np.roll(vector(padded[i]), 2) * np.roll(vector(padded[i + 1]), 1) * vector(padded[i + 2])
               for i in range(len(padded) - 2) if padded[i + 1] != " ")
    assert (bundler.bundles(*bundler.counts([text]), 1)[0] == want).all()


def test_awkward_rows(docs, empty):
    out = {r.doc_id: r for r in L.identify(docs).collect() if r.doc_id is not None}
    assert out[1].lang_pred == out[2].lang_pred == out[3].lang_pred == "und" and out[1].score == 0
    assert out[9].lang_pred in ("en", "fr") and out[12].lang_pred in ("en", "fr")
    assert L.identify(docs).count() == docs.count()
    assert L.identify(empty).count() == 0


def test_nothing_to_learn(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in L.identify(docs).collect()} == {"und"}
