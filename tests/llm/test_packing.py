import random
import zlib
from functools import cache

import numpy as np
import pytest
from backdrop.llm import bin_completion as B
from backdrop.llm import packing as P
from backdrop.llm import tokens as T
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import awkward, prose, row


def counts_of(lengths, capacity):
    return np.bincount(np.array(lengths, np.int64), minlength=capacity + 1)


def check(patterns, lengths):
    """The number of bins; every piece is in one and no bin is too full."""
    got = sorted(x for n, held in patterns for x, k in held for _ in range(n * k))
    assert got == sorted(lengths)
    return sum(n for n, _ in patterns)


def fewest(lengths, capacity):
    """Bins of an optimal packing, by trying all."""
    lengths = sorted(lengths, reverse=True)

    @cache
    def go(i, bins):
        if i == len(lengths):
            return len(bins)
        tried = [go(i + 1, tuple(sorted((*bins[:j], bins[j] - lengths[i], *bins[j + 1 :])))) for j in range(len(bins)) if bins[j] >= lengths[i]]
        return min([*tried, go(i + 1, tuple(sorted((*bins, capacity - lengths[i]))))])

    return go(0, ())


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 30).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=9))))
def test_optimal_on_small_inputs(case):
    capacity, lengths = case
    counts = counts_of(lengths, capacity)
    patterns = B.solve(counts)
    assert all(sum(x * k for x, k in held) <= capacity for _, held in patterns)
    best = fewest(lengths, capacity)
    assert check(patterns, lengths) == best
    assert B.lower_bound(counts) <= best <= check(B.best_fit(counts), lengths)


def plain_best_fit(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fits = [j for j, r in enumerate(bins) if r >= x]
        if fits:
            bins[min(fits, key=bins.__getitem__)] -= x
        else:
            bins.append(capacity - x)
    return sorted(bins)


def test_best_fit_of_equal_bins_is_best_fit():
    rng = random.Random(1)
    for capacity, n in ((10, 60), (50, 200), (97, 300), (2048, 400)):
        lengths = [rng.randint(1, capacity) for _ in range(n)]
        patterns = B.best_fit(counts_of(lengths, capacity))
        check(patterns, lengths)
        assert sorted(capacity - sum(x * k for x, k in held) for m, held in patterns for _ in range(m)) == plain_best_fit(lengths, capacity)


def test_the_search_beats_best_fit():
    # Best fit decreasing needs three bins of ten for these, two are enough.
    lengths = [5, 4, 4, 3, 2, 2]
    counts = counts_of(lengths, 10)
    assert check(B.best_fit(counts), lengths) == 3 and check(B.solve(counts), lengths) == 2


def test_dominated_fillings_are_left_out():
    counts = counts_of([5, 3, 3, 2, 1], 12)
    assert B.fillings(counts, 6) == [(5, 1), (3, 3)]  # 3 + 2 + 1 and 5 alone are dominated
    assert B.fillings(counts, 3) == [(3,)]


def test_large_counts():
    rng = np.random.default_rng(0)
    counts = np.bincount(np.minimum(rng.lognormal(5.5, 1, 2_000_000).astype(int) + 1, 2048), minlength=2049)
    patterns = B.solve(counts)
    assert sum(n for n, _ in patterns) == B.lower_bound(counts) and len(patterns) < 3 * 2048
    held = np.zeros(2049, np.int64)
    for n, pieces in patterns:
        assert sum(x * k for x, k in pieces) <= 2048
        for x, k in pieces:
            held[x] += n * k
    assert np.array_equal(held, counts)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.default_path())


ODD = ["", "İstanbul ΟΔΟΣ, Σ. ΣΣ.,", "a\x1cb c\x85D.", "it's We'LL. x.,y., 3.14. é., 你好., <|endoftext|>., <|STARTOFTEXT|> <|startoftext|>x",
       "!., ʰ., Ⅷ., ½., _., ٣., é., ́ a", "x" * 9000, "".join(map(chr, range(0xC0, 0x250))), " ".join(map(chr, range(0xA0, 0x260))), " ".join(f"a{chr(c)}B" for c in range(0x80, 0x250)), "A.　B, C", "...,,, .a ,b"]


def test_ids_are_the_librarys(library, monkeypatch):
    monkeypatch.setattr(T, "SLICE_CHARS", 40)
    encoder = P.WordEncoder(T.tokenizer_text(P.default_path()))
    for texts in (ODD, ODD[::-1], [t + prose(5, 400) + t for t in ODD]):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


@cache
def both():
    return Tokenizer.from_file(P.default_path()), P.WordEncoder(T.tokenizer_text(P.default_path()))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé.,'s9 \n\x1c你́<|endoftext|>ΣİⅠ"), max_size=60))
def test_any_text(text):
    library, coder = both()
    assert coder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def want_pieces(rows, library):
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            raw = np.array(ids[s : s + 2048], "<u4").tobytes()
            yield r[0], k, s, len(raw) // 4, zlib.crc32(raw), raw


def test_awkward_rows(table, empty, library):
    # A hot length, and copies of a long text.
    rows = awkward() + [row(100 + i, prose(3, 40)) for i in range(300)] + [row(500 + i, prose(i, 300 + 7 * i)) for i in range(60)]
    packed = P.pack_documents(table(rows), P.default_path(), with_ids=True).cache()
    got = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got), key=repr) == sorted(want_pieces(rows, library), key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 2048
    assert len(bins) == B.lower_bound(counts_of([r.length for r in got], 2048))
    made = {r.sequence_id: r for r in P.sequences(packed).collect()}
    assert made.keys() == bins.keys()
    for r in got:
        assert bytes(made[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert P.pack_documents(empty, P.default_path()).count() == 0
