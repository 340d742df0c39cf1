import hashlib
import re

import pytest
from backdrop.llm import fill_middle as M
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import awkward, row

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("a\né\r你"), max_size=60), st.integers(1, 9))
def test_cuts_are_those_of_the_pattern(text, block):
    tree = M.UnitTree(text, block)
    units = UNIT.findall(text)
    assert tree.n == len(units)
    assert [tree.end_of(k) for k in range(tree.n + 1)] == [len("".join(units[:k])) for k in range(tree.n + 1)]


def test_a_very_long_text():
    text = "".join(f"line {i}\n" * (i % 3) + "\n" for i in range(200_000)) + "end"
    units = UNIT.findall(text)
    tree = M.UnitTree(text)
    assert tree.n == len(units)
    for k in (0, 1, 777, len(units) // 2, len(units) - 1, len(units)):
        assert tree.end_of(k) == len("".join(units[:k]))


def by_definition(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_awkward_rows(table, empty):
    texts = ["\n", "\n\n\n", "a\nb", "a\r\nb\n", "<S", "P><", "x<M>y", "<P", "<P\n<S\n<M\n>", "><P\n\nS>\n<", "你\n好\n\U0001f600\n"]
    rows = awkward() + [row(100 + i, t) for i, t in enumerate(texts * 6)]
    made = M.fill_in_middle(table(rows))
    got = made.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((r[:6] for r in got), key=repr) == sorted((by_definition(r[0], r[1]) for r in rows), key=repr)
    assert sorted(r.back for r in got) == sorted(r[1] or "" for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert M.fill_in_middle(empty).count() == 0


def test_rates(table):
    rows = [row(i, "a\nb\nc") for i in range(1000)]
    forms = [r.form for r in M.fill_in_middle(table(rows), M.Rule(rate=40, spm_rate=0)).collect()]
    assert set(forms) == {"plain", "psm"} and 340 < forms.count("psm") < 460


def test_sentinels_that_could_arise_by_chance_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "x<", "<M>"), ("<P>", "<<P>>", "<M>")):
        with pytest.raises(ValueError):
            M.Rule(*marks)
