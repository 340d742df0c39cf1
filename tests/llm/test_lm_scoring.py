import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
from backdrop.llm import lm_scoring as L

from tests.llm.conftest import awkward, prose, row


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def trained_on(rows):
    return [r for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2]


def brute_base(rows):
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]
    c = Counter(w for r in trained_on(rows) for w in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    return [(len(tokens(r[1])), sum(c[w] > 0 for w in tokens(r[1])), n,
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(r[1]))) for r in rows]


def brute_tree(rows):
    """Context trees as dictionaries, and the log10 probability of a text."""
    pad = b"\xff" * L.DEPTH
    steps = lambda t: [(s, i, k) for s in [pad + lower(t).encode() + b"\xff"] for i in range(L.DEPTH, len(s)) for k in range(8)]
    place = lambda s, i, k: (1 << k | s[i] >> 8 - k, s[i] >> 7 - k & 1)
    count, longer = defaultdict(lambda: [0, 0]), defaultdict(set)
    for r in trained_on(rows):
        for s, i, k in steps(r[1]):
            node, bit = place(s, i, k)
            for d in range(L.DEPTH + 1):
                count[s[i - d : i], node][bit] += 1
                if d:
                    longer[s[i - d + 1 : i], node].add((s[i - d : i], node))
    weighted, share = {}, {}
    for at in sorted(count, key=lambda x: -len(x[0])):
        a, b = count[at]
        kt = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        weighted[at], share[at] = kt, 1.0
        if len(at[0]) < L.DEPTH:
            weighted[at] = np.logaddexp(kt, sum(weighted[x] for x in longer[at])) - math.log(2)
            share[at] = math.exp(kt - math.log(2) - weighted[at])

    def score(text):
        total = 0.0
        for s, i, k in steps(text):
            node, bit = place(s, i, k)
            p = None
            for d in range(L.DEPTH, -1, -1):
                if (n := count.get((s[i - d : i], node))) is not None:
                    own, w = (n[bit] + 0.5) / (sum(n) + 1), share[s[i - d : i], node]
                    p = own if p is None else w * own + (1 - w) * p
            total += math.log10(0.5 if p is None else p)
        return total

    return score


def test_against_explicit_trees(table):
    rows = [row(i, prose(i, 12).capitalize() + " Éa\t\x0bx") for i in range(60)] + awkward()[:4] + [awkward()[6][:1] + ("q" * 40,) + awkward()[6][2:]]
    out = L.score_documents(table(rows)).collect()
    score, base = brute_tree(rows), brute_base(rows)
    want = sorted((*b[:3], round(b[3], 6), round(score(r[1]), 4)) for r, b in zip(rows, base, strict=True))
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 4)) for r in out)
    assert np.allclose(want, got, atol=2e-3)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in out if r.doc_id is not None)


def test_probabilities_of_all_next_bytes_add_up():
    tree = L.Tree([])
    keys, _ = L.grams_of([prose(1, 300).encode()])
    distinct, n = np.unique(keys, return_counts=True)
    context = distinct[5] >> np.uint64(8)
    every = np.union1d(distinct, (context << np.uint64(8)) | np.arange(256, dtype=np.uint64))
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, distinct)] = n
    p = 10 ** tree.log10(every, counts)[(every >> np.uint64(8)) == context]
    assert len(p) == 256 and abs(p.sum() - 1) < 1e-9


def test_awkward_rows(docs, empty):
    out = L.score_documents(docs).collect()
    assert len(out) == len(awkward())
    assert all(r.n_tokens == 1 for r in out if r.doc_id in (1, 2, 3)) and all(r.score < 0 and r.base_score < 0 for r in out)
    assert len({(r.score, r.base_score) for r in out if r.doc_id in (6, 7)}) == 1
    assert L.score_documents(empty).count() == 0


def test_nothing_to_learn_from(table):
    out = L.score_documents(table([row(1, "ab c")]), held_out=zlib.crc32(b"1") % 7).first()
    assert (out.n_known, out.train_tokens) == (0, 0) and abs(out.score - 5 * 8 * math.log10(0.5)) < 1e-5


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.5, 1000.5, 1e9])
    assert np.allclose(L.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)


def test_a_bucket_is_weighed_some_contexts_at_a_time(monkeypatch):
    rng = np.random.default_rng(8)
    grams = np.unique(rng.integers(0, 1 << 48, 300_000, np.uint64) & np.uint64(0xFFFFFFFF3FFF))
    counts = rng.integers(0, 4, len(grams))
    tree = L.Tree([])
    tracemalloc.start()
    got = tree.log10(grams, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20
    some = np.isin(grams >> np.uint64(8) & np.uint64(0xFFFF), np.arange(40, 60))
    assert np.array_equal(got[some], tree._log10(grams[some], counts[some]))
    table = L.pa.table({"keys": [L.pack_keys(grams)], "counts": [L.pack(counts.astype("<i8"))]})
    key = (L.pa.scalar(L.GRAM), L.pa.scalar(0))
    top = L._top(key, table)
    monkeypatch.setattr(L, "WEIGHED_GRAMS", 1 << 30)
    assert L._top(key, table).equals(top)


def test_parts_hold_whole_pairs_of_bytes_and_every_gram_once(monkeypatch):
    monkeypatch.setattr(L, "WEIGHED_GRAMS", 50)
    pairs = np.repeat(np.arange(300, 340), np.arange(1, 121, 3))
    grams = np.sort(pairs.astype(np.uint64) << np.uint64(8) | np.arange(len(pairs), dtype=np.uint64) << np.uint64(30))
    parts = list(L.parts_of(grams))
    pair = grams >> np.uint64(8) & np.uint64(0xFFFF)
    assert np.array_equal(np.sort(np.concatenate(parts)), np.arange(len(grams)))
    assert sum(len(np.unique(pair[x])) for x in parts) == 40 and all(len(x) <= 50 or len(np.unique(pair[x])) == 1 for x in parts)
    assert not list(L.parts_of(grams[:0]))
