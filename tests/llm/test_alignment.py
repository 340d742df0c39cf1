from collections import Counter
from functools import cache

import sentencepiece
from backdrop.llm import alignment as A
from backdrop.llm import tokens as T
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import awkward, prose, row


@cache
def libraries():
    first = Tokenizer.from_file(T.default_path())
    first.encode_special_tokens = True
    with open(A.default_path(), "rb") as f:
        aligner = A.Aligner(T.tokenizer_text(T.default_path()), f.read())
    return first, sentencepiece.SentencePieceProcessor(model_file=A.default_path()), aligner


def by_definition(text):
    """Groups of (first ids, second ids) of the whole text."""
    first, second, _ = libraries()
    if not text:
        return []
    symbols = T.byte_symbols()
    a = [(i, bytes(symbols[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text, num_threads=1):
        p = second.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
    data = (" " + text).encode()
    if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
        return []
    ends = lambda t: {sum(len(x) for _, x in t[: i + 1]): i + 1 for i in range(len(t))} if len(t) < 300 else dict(_ends(t))
    ea, eb = ends(a), ends(b)
    out, i, j = [], 0, 0
    for e in sorted(set(ea) & set(eb)):
        out.append(([x for x, _ in a[i : ea[e]]], [x for x, _ in b[j : eb[e]]]))
        i, j = ea[e], eb[e]
    return out


def _ends(tokens):
    at = 0
    for i, (_, x) in enumerate(tokens):
        at += len(x)
        yield at, i + 1


def as_text(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


ODD = ["a", " ", "  a  b ", "\n\nx\r\ny;\r\nz\r", "a\rb \r c\r", "tab\there\n\tx", "<|endoftext|> <s>x</s> <unk> <0x41>", "a▁b c", "a b ▁",
       "你好 世界。　x\xa0y", "a\x00b\x1cc", "x" * 9000, "é ́  z \u0085q", "\U0001f600\U0001f468‍\U0001f469 ok", "ﬁn ½"]


def test_odd_texts(monkeypatch):
    for slice_chars in (1 << 18, 7):
        monkeypatch.setattr(T, "SLICE_CHARS", slice_chars)
        for text, made in zip(ODD * 2, libraries()[2].align(ODD * 2), strict=True):
            want = by_definition(text)
            assert ";".join(made[3]) == as_text(want), text
            assert made[:3] == (sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want))
            assert sorted(made[4].tolist()) == sorted(a << 32 | b for x, y in want for a in x for b in y)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'sé你 \n\t\r;)}{▁　\xa0\x1c1,.<s>"), max_size=60))
def test_any_text(text):
    made = next(libraries()[2].align([text]))
    assert ";".join(made[3]) == as_text(by_definition(text))


def measures(rows):
    groups = [by_definition(r[1]) for r in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for one in links for p in one)
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    return [(r[0], sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
             sum(n for p, n in one.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in one.items()), as_text(g))
            for r, g, one in zip(rows, groups, links, strict=True)]


def test_awkward_rows(table, empty, monkeypatch):
    # A hot text, and blocks that share pairs.
    rows = awkward() + [row(100 + i, t) for i, t in enumerate(ODD)] + [row(200 + i, prose(3, 40)) for i in range(80)] + [
        row(300 + i, prose(i, 30)) for i in range(40)]
    monkeypatch.setattr(A, "BLOCK_CHARS", 1000)
    for hot in (1000, 5):
        monkeypatch.setattr(A, "HOT_TEXTS", hot)
        got = A.align_documents(table(rows), T.default_path(), A.default_path()).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(measures(rows), key=repr)
    assert A.align_documents(empty, T.default_path(), A.default_path()).count() == 0
    none = table([row(1, None), row(2, "")])
    assert [tuple(r)[1:] for r in A.align_documents(none, T.default_path(), A.default_path(), digest=True).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_pair_counts(table):
    rows = [row(i, t) for i, t in enumerate(["ab cd"] * 3 + ["ab ab", "cd", "▁"])]
    blocks = A.aligned_blocks(table(rows), T.default_path(), A.default_path())
    want = Counter(p for r in rows for p in {(x, y) for a, b in by_definition(r[1]) for x in a for y in b})
    assert {(r.a_id, r.b_id): r.documents for r in A.pair_counts(blocks).collect()} == want
