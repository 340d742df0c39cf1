import random
from collections import Counter, defaultdict

import numpy as np
from backdrop.llm import near_dedup as N
from pyspark.sql import functions as F

from tests.llm.conftest import awkward, prose, row


def plain(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def classes(rows):
    """Brute force: single linkage over plain Jaccard similarity of all pairs, copies included."""
    texts = sorted({r[1] or "" for r in rows})
    sets = [plain(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= N.SIMILARITY:
                root[find(i)] = find(j)
    group = defaultdict(list)
    for r in rows:
        group[find(texts.index(r[1] or ""))].append(r[0])
    return {min(i for i in ids if i is not None): Counter(ids) for ids in group.values() if any(i is not None for i in ids)}


def near_rows():
    rng = random.Random(5)
    rows = []
    for g in range(25):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(60, 200))]
        for k in range(rng.randrange(1, 6)):
            words = list(base)
            for _ in range(rng.choice((0, 1, 1, 2)) if k else 0):
                words[rng.randrange(len(words))] = f"v{rng.randrange(4000)}"
            rows.append(row(1000 + 10 * g + k, " ".join(words)))
    return rows


def test_against_all_pairs(table):
    rows = near_rows() + awkward()
    out = N.near_groups(table(rows)).collect()
    assert len(out) == len(rows)
    got = defaultdict(Counter)
    for r in out:
        got[r.class_id][r.doc_id] += 1
        assert r.kept == (r.doc_id == r.class_id)
    want = classes(rows)
    assert {k: v for k, v in got.items() if k is not None} == want


def test_rows_that_stay(table, docs, empty):
    rows = near_rows()
    kept = N.drop_near_copies(table(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(classes(rows)) and kept.columns == docs.columns
    assert N.drop_near_copies(empty).count() == 0 and N.near_groups(empty).count() == 0


def test_a_large_bucket_is_worked_on_in_blocks(table, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        words[i % 100] = f"v{i}"
        rows.append(row(i, " ".join(words)))
    out = N.near_groups(table(rows)).collect()
    assert {r.class_id for r in out} == {0}


def test_samples_agree_by_weighted_similarity():
    rng = random.Random(6)
    texts = []
    for i in range(300):
        words = [f"w{rng.randrange(50)}" for _ in range(200)]
        other = words[: 200 - i % 100] + [f"v{rng.randrange(50)}" for _ in range(i % 100)]
        texts += [" ".join(words), " ".join(other)]
    of, found, n = N.shingles(texts)
    weigher = N.Weigher(10)
    drawn = weigher.samples(of, found, n, np.zeros(len(n)))
    error = []
    for i in range(0, len(texts), 2):
        a, b = ((found[of == k], weigher.weights(found[of == k], n[of == k], np.zeros((of == k).sum()))) for k in (i, i + 1))
        error.append((drawn[:, i] == drawn[:, i + 1]).mean() - N.similarity(a, b)[0])
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.075


def test_weighted_similarity_by_definition():
    a, b = "a b c d e f a b c d e f", "a b c d e f g h"
    count = lambda t: Counter(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4))
    x, y = count(a), count(b)
    weigher = N.Weigher(3)  # df 0: one weight for all
    sides = []
    for t in (a, b):
        _, found, n = N.shingles([t])
        sides.append((found, weigher.weights(found, n, np.zeros(len(n)))))
    want = sum((x & y).values()) / sum((x | y).values())
    got = N.similarity(*sides)
    assert abs(got[0] - want) < 1e-12 and abs(got[1] - len(x.keys() & y) / len(x.keys() | y)) < 1e-12


def test_folded_values():
    texts = ["", "a", "é\n" * 1000, "\x00", ""]
    assert N.unfolded(N.folded(texts)) == texts and N.unfolded(N.folded([])) == []
    for bits in (6, 9, 16):
        for part in (0, 5, (1 << bits) - 1):
            low = np.random.default_rng(part).integers(0, 1 << 52 - bits, 3000, np.uint64)
            found = np.unique(low) | np.uint64(part) << np.uint64(52 - bits)
            assert np.array_equal(N.unpacked(N.packed(found), len(found), part, bits), found)
    n = np.array([1, 1, 1 << 31, 7])
    assert np.array_equal(N.counts_of(N.squeezed(n)), n)


def test_forest_is_maximal():
    signs = np.random.default_rng(1).integers(0, 3, (40, N.SAMPLES))
    share = (signs[:, None] == signs[None]).mean(2)
    root = list(range(40))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    want = 0.0
    for s, i, j in sorted(((share[i, j], i, j) for i in range(40) for j in range(i)), reverse=True):
        if s >= N.LEAST_SHARE and find(i) != find(j):
            root[find(i)] = find(j)
            want += s
    assert abs(sum(share[i, j] for i, j in N.forest(signs)) - want) < 1e-9


def test_failed_links_of_a_forest_are_replaced(table):
    """Pages of one template: pairs at 0.83 among texts that are all at 0.72 to each other."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(60):
        both = [f"b{g}x{i}" for i in range(33)]
        for k in range(2):
            rows.append(row(2 * g + k, " ".join(base + both + [f"u{g}x{k}x{i}" for i in range(44)])))
    out = N.near_groups(table(rows)).collect()
    got = defaultdict(Counter)
    for r in out:
        got[r.class_id][r.doc_id] += 1
    want = classes(rows)
    assert len(want) == 60 and got == want


def test_repeated_lines_do_not_hide_equal_sets(table):
    """Equal shingle sets whose weighted similarity is under a half."""
    rows = []
    for g in range(40):
        body, line = " ".join(f"w{g}x{i}" for i in range(100)), " ".join(f"r{g}x{i}" for i in range(5))
        rows += [row(2 * g + k, f"{body} {' '.join([line] * n)}") for k, n in enumerate((100, 300))]
    rows += [row(1000 + i, prose(i, 40)) for i in range(40)]
    of, found, n = N.shingles([rows[0][1], rows[1][1]])
    weigher = N.Weigher(10)
    weighted, same = N.similarity(*((found[of == k], weigher.weights(found[of == k], n[of == k], np.zeros((of == k).sum()))) for k in (0, 1)))
    assert weighted < 0.5 and same == 1
    out = {r.doc_id: r.class_id for r in N.near_groups(table(rows)).collect()}
    assert all(out[2 * g] == out[2 * g + 1] == 2 * g for g in range(40))


def test_plain_samples_agree_by_plain_similarity():
    rng = random.Random(7)
    texts = []
    for i in range(300):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        texts += [" ".join(words), " ".join(words[: 200 - i % 100] + [f"v{rng.randrange(5000)}" for _ in range(i % 100)])]
    of, found, _ = N.shingles(texts)
    drawn = N.plain_samples(of, found)
    error = [(drawn[:, i] == drawn[:, i + 1]).mean() - len(plain(texts[i]) & plain(texts[i + 1])) / len(plain(texts[i]) | plain(texts[i + 1]))
             for i in range(0, len(texts), 2)]
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.075


def test_frequencies_are_exact_and_by_batch(spark, table, monkeypatch):
    monkeypatch.setattr(N, "ASK_CHARS", 20, raising=False)
    rows = near_rows() + awkward() + [row(9000 + i, " ".join(f"z{i}x{k}" for k in range(60_000))) for i in range(8)]
    _, links = N.near_links(table(rows))
    texts = {bytes(r.node): r.text for r in table(rows).select(N.node_of(F.col("text")).alias("node"), "text").collect()}
    df = Counter(s for r in rows for s in plain(r[1] or ""))
    weight = lambda t: {s: n * (1 + np.log((len(rows) + 1) / (df[s] + 1)) / np.log(len(rows) + 2)) for s, n in
                        Counter(tuple(t.lower().split()[i : i + 5]) for i in range(len(t.split()) - 4)).items()}
    found = links.collect()
    assert len(found) > 20
    for r in found:
        x, y = weight(texts[bytes(r.a)]), weight(texts[bytes(r.b)])
        least = sum(min(x[s], y[s]) for s in x.keys() & y.keys())
        assert abs(r.weighted - least / (sum(x.values()) + sum(y.values()) - least)) < 1e-9


def test_one_row_of_a_class_without_ids_or_of_one_id(table):
    body = prose(41, 80)
    rows = [row(None, f"{body} {x}") for x in ("ba", "ke")] + [row(7, f"{prose(42, 80)} {x}") for x in ("lo", "mi")]
    out = N.near_groups(table(rows)).collect()
    assert Counter((r.class_id, r.kept) for r in out) == {(None, True): 1, (None, False): 1, (7, True): 1, (7, False): 1}
    assert N.drop_near_copies(table(rows)).count() == 2


def kept(weigher, texts, df):
    out = []
    for t in texts:
        _, found, n = N.shingles([t])
        often = np.array([df[int(s)] > 1 for s in found])
        times = np.array([df[int(s)] for s in found])
        rest = float(weigher.weights(found, n, times)[~often].sum()), int((~often).sum())
        out.append(N.kept_shingles(found[often], n[often], times[often], rest))
    return out


def test_similarities_by_shared_shingles_alone(monkeypatch):
    monkeypatch.setattr(N, "COMPARED", 150)
    base = prose(51, 80).split()
    texts = [" ".join(base[:i] + [f"v{i}"] + base[i:] + base[: i // 7]) for i in range(0, 80, 4)]
    df = Counter(int(s) for t in texts for s in N.shingles([t])[1])
    weigher = N.Weigher(len(texts))
    shared = kept(weigher, texts, df)
    assert all(len(N.unkept(x)[0]) < len(N.shingles([t])[1]) for x, t in zip(shared, texts, strict=True))
    sets = N.Texts(weigher, shared)
    whole = []
    for t in texts:
        _, found, n = N.shingles([t])
        whole.append((found, weigher.weights(found, n, np.array([df[int(s)] for s in found]))))
    for at in (3, 0, 19):
        others = np.array([i for i in range(len(texts)) if i != at])
        got = np.column_stack(sets.similarities(at, others))
        assert np.allclose(got, [N.similarity(whole[at], whole[i]) for i in others], atol=1e-12)


def test_rows_of_a_bucket_that_are_all_near_give_no_more_links_than_join_them():
    texts = [f"{prose(52, 80)} v{i}" for i in range(60)]
    df = Counter(int(s) for t in texts for s in N.shingles([t])[1])
    weigher = N.Weigher(len(texts))
    sets = N.Texts(weigher, kept(weigher, texts, df))
    bands, signs = np.zeros((60, 2 * N.BANDS), np.int64), np.zeros((60, 2 * N.SAMPLES), np.uint32)
    roots = np.arange(60) % 20
    assert len(list(N.joining(0, bands, signs, roots, None, sets))) == 19
    assert not list(N.joining(1, bands, signs, roots, None, sets))  # looked at in the first bucket that they share
    across = list(N.joining(0, bands, signs, roots, np.arange(60) // 30, sets))
    assert 0 < len(across) <= 19 and all(i // 30 != j // 30 for i, j, *_ in across)


def test_groups_of_a_large_bucket_do_not_grow_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rows = [(bytes([i, 1]), [7, 8], b"s", b"x" * 9, b"r" if i < 150 else bytes([i, 1])) for i in range(160)]
    nodes = spark.createDataFrame(rows, "node binary, bands array<bigint>, sign binary, shared binary, root binary")
    assert N._forests(nodes.drop("root")).count() <= 2 * 2 * 160
    groups = N._apart(nodes).collect()
    # Both buckets hold the same texts; those of the largest root meet the other block alone.
    assert {(r.key, r.position) for r in groups} == {(7, 0)} and len(groups) <= 150 + 10 * 12
    met = {}
    for r in groups:
        met.setdefault((r.i, r.j), []).append(bytes(r.node))
    pairs = {tuple(sorted((a, b))) for nodes in met.values() for a in nodes for b in nodes if a != b}
    assert all(tuple(sorted((bytes([i, 1]), bytes([j, 1])))) in pairs for i in range(150, 160) for j in range(160) if i != j)


def test_texts_that_share_too_little_are_no_candidates(table, monkeypatch):
    """A line in all texts, and a pair just near: only the pair has bands."""
    seen = {}
    forests = N._forests
    monkeypatch.setattr(N, "_forests", lambda nodes: seen.setdefault("nodes", nodes) and forests(nodes))
    line = prose(60, 12)
    rows = [row(i, f"{line} {' '.join(f'w{i}x{k}' for k in range(60))}") for i in range(30)]
    rows += [row(100 + k, f"{line} {' '.join(f'y{i}' for i in range(80))} z{k}") for k in range(2)]
    out = {r.doc_id: r.class_id for r in N.near_groups(table(rows)).collect()}
    assert seen["nodes"].count() == 2 and out[101] == out[100] == 100 and len(set(out.values())) == 31
