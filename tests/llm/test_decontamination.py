import random

from backdrop.llm import decontamination as D
from backdrop.llm.words import groups, word_hashes

from tests.llm.conftest import awkward, prose, row


def edit_distance(item, text):
    """Plain dynamic programme: the item against any passage of the text."""
    last = list(range(len(item) + 1))
    best = last[-1]
    for w in text:
        now = [0]
        for i, x in enumerate(item):
            now.append(min(last[i] + (x != w), last[i + 1] + 1, now[i] + 1))
        last, best = now, min(best, now[-1])
    return best


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        i = rng.randrange(len(words))
        words[i : i + rng.choice((0, 1))] = rng.choice(([], ["zap"], ["zip"]))
    return " ".join(words)


def test_against_the_plain_programme():
    rng = random.Random(3)
    items = [prose(100 + i, rng.randrange(9, 60)) for i in range(40)]
    texts, sure = [], []
    for i in range(200):
        item = rng.choice(items)
        texts.append(" ".join((prose(1000 + i, 60), edited(rng, item, rng.choice((0, 0, 1, 2, 5, 9))), prose(2000 + i, 40))))
    index = D.ItemIndex(list(range(len(items))), items)
    found = [x for g in groups(texts) for x in index.leaks(texts[g])]
    for t, rows in zip(texts, found, strict=True):
        words = D.words_of(t)
        want = {}
        for i, item in enumerate(items):
            n = D.words_of(item)
            d = edit_distance(n, words)
            if d <= int(len(n) * (1 - D.SIMILARITY) + 1e-9):
                want[i] = d
        got = {i: d for i, d, _, _ in rows}
        assert all(want.get(i) == d for i, d in got.items())
        sure.append((len(want), len(got)))
    assert sum(g for _, g in sure) >= 0.97 * sum(w for w, _ in sure) > 100


def test_bit_vectors_and_bound():
    rng = random.Random(4)
    for _ in range(200):
        item = [rng.choice("abcd") for _ in range(rng.randrange(1, 70))]
        text = [rng.choice("abcde") for _ in range(rng.randrange(0, 90))]
        index = D.ItemIndex([0], [" ".join(item)])
        hit = index.distance(0, word_hashes([text])[0].tolist(), len(item))
        assert hit[0] == edit_distance(item, text)


def test_awkward_rows(spark, docs, empty):
    schema = "item_id long, text string"
    benchmark = spark.createDataFrame([(1, awkward()[7][1]), (2, None), (3, " .. "), (4, awkward()[7][1]), (5, "one")], schema)
    got = sorted((r.doc_id, r.item_id) for r in D.find_leaks(docs, benchmark).collect())
    assert got == sorted([(6, 1), (6, 1), (7, 1), (6, 4), (6, 4), (7, 4), (9, 5)])
    clean = D.drop_leaks(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(awkward()) - 4
    nothing = spark.createDataFrame([], schema)
    assert D.find_leaks(docs, nothing).count() == 0 and D.drop_leaks(docs, nothing).count() == len(awkward())
    assert D.find_leaks(empty, benchmark).count() == 0 and D.drop_leaks(empty, benchmark).count() == 0


def test_items_in_blocks(spark, table, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 2)
    items = [(i, prose(50 + i, 20)) for i in range(7)]
    docs = table([row(i, prose(i, 30) + " " + t.upper() + "!") for i, t in items] + [row(99, prose(99, 30))])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in D.find_leaks(docs, benchmark).collect()) == [(i, i) for i in range(7)]
    assert [r.doc_id for r in D.drop_leaks(docs, benchmark).collect()] == [99]
