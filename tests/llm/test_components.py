import random

from backdrop.llm.components import components


def test_against_union_find(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    root = list(range(400))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for ab in links for x in ab if find(x) != x}
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want


def test_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
