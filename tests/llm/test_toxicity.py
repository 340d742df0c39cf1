import random

import numpy as np
from backdrop.llm import toxicity as X

from tests.llm.conftest import WORDS, awkward, prose, row


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        at, of = X.window_rows([n, 5])
        assert set(at[of == 0].ravel()) - {-1} == set(range(n)) and (of == 0).sum() >= 1
        assert set(at[of == 1].ravel()) - {-1} == set(range(n, n + 5))


def test_gradient():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in X._initial(rng, 6).items()}
    m["words"][1:] = rng.standard_normal((6, X.WIDTH))
    m["chars"] *= 20
    number = {w: i + 1 for i, w in enumerate(WORDS[:6])}
    words = WORDS[:9]
    ids = rng.integers(-1, 9, (3, X.WINDOW))
    ids[0, 20:] = -1
    labels, weights = np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        z = X.window_logits(m, number, words, ids).astype(float)
        return np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels))

    g = X._gradient(m, number, words, ids, labels, weights)
    for name in m:
        flat = m[name].reshape(-1)
        for i in np.argsort(-np.abs(g[name].reshape(-1)))[:4]:
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - g[name].reshape(-1)[i]) < 2e-3 + 0.05 * abs(g[name].reshape(-1)[i]), name


def make(seed, n):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(5, 150))]
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "grumf" + rng.choice(WORDS)]))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_learns_words_and_stems():
    net = X.train(*make(1, 700), 0.25)
    texts, labels = make(2, 300)
    said = net.scores(texts) >= 0.5
    assert (said == np.array(labels)).mean() > 0.97
    assert 0 <= net.scores([""])[0] < 0.5


def test_queries_on_awkward_rows(spark, table, docs, empty):
    texts, labels = make(3, 400)
    known = table([row(1000 + i, t) for i, t in enumerate(texts)]).unionByName(docs)
    marks = spark.createDataFrame([(1000 + i, y) for i, y in enumerate(labels)] + [(None, 1), (1, None), (4, 7)], "doc_id long, toxic int")
    net = X.learn(known, marks)
    out = X.score_rows(docs, net, score_col="toxicity")
    assert out.columns == [*docs.columns, "toxicity"]
    rows = out.collect()
    assert len(rows) == len(awkward()) and all(0 <= r.toxicity <= 1 for r in rows)
    assert len({round(r.toxicity, 9) for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({round(r.toxicity, 5) for r in rows if r.doc_id in (6, 7)}) == 1
    assert X.score_rows(empty, net, score_col="toxicity").count() == 0
    constant = X.learn(docs, marks.where("toxic = 0"))
    assert {r.toxicity for r in X.score_rows(docs, constant, score_col="toxicity").collect()} == {0.0}
    assert X.learn(empty, marks.limit(0)).scores(["a"]).tolist() == [0.0]


def test_long_texts_are_scored_whole():
    net = X.train(*make(1, 700), 0.25)
    calm = prose(8, 20_000)
    assert net.scores([calm])[0] < 0.5 <= net.scores([calm + " idiot idiot grumfbaran " + calm])[0]
