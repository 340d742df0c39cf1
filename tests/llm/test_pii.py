import random
import re

from backdrop.llm import pii as P

from tests.llm.conftest import awkward, prose, row

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.findall("[0-9]", m[0])
            double = [sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 12 <= len(digits) <= 19 and sum(double) % 10 == 0, "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


def test_patterns():
    rng = random.Random(2)
    for alphabet in ("a1.@+- ()%29", "0123456789- ", "12.5@a", "+1 23()-."):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40)))
            assert P.find_entities(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000 + ".", "1." * 100_000, "+1" * 50_000, "a@" * 50_000):
        P.find_entities(text)


def test_disclosing_terms(table):
    rows = [row(i, f"{prose(i, 20)} zorblax writes to ann.b@mail.example.com about the bake {prose(100 + i, 20)}") for i in range(6)]
    rows += [row(50 + i, prose(300 + i, 30) + " the writes to about") for i in range(200)]
    out = {r.doc_id: r for r in P.personal_data(table(rows)).collect()}
    for i in range(6):
        text = rows[i][1]
        named = {text[t["start"] : t["end"]] for t in out[i].terms}
        assert "zorblax" in named and "writes" not in named and "the" not in named
        assert [text[b["start"] : b["end"]] for b in out[i].base] == ["ann.b@mail.example.com"]
    assert all(not out[i].terms and not out[i].base and out[i].text is None for i in out if i >= 50)
    clean = {r.doc_id: r.sanitised for r in P.sanitised(table(rows)).collect()}
    assert sorted(clean) == list(range(6))
    assert all("[EMAIL]" in t and "zorblax" not in t and "ann.b" not in t and "writes to" in t for t in clean.values())


def test_copies_disclose_nothing(table):
    rows = [row(i, "qua zorblax ann.b@mail.example.com") for i in range(9)] + [row(50 + i, prose(i, 9)) for i in range(20)]
    assert all(not r.terms for r in P.personal_data(table(rows)).collect())


def test_awkward_rows(docs, empty):
    out = P.personal_data(docs).collect()
    assert len(out) == len(awkward()) and all(not r.base and not r.terms for r in out)
    assert P.personal_data(empty).count() == 0 and P.sanitised(empty).count() == 0


def test_terms_far_from_a_mention_and_without_one(table):
    mail = "ann.b@mail.example.com"
    rows = [row(i, f"Quibblewort {prose(i, 30)} writes to {mail} {prose(100 + i, 30)} quibblewort") for i in range(6)]
    rows += [row(20 + i, f"fizzlebaum {prose(500 + i, 30)} bob.{'c' * 3}@mail.example.com") for i in range(2)]
    rows += [row(40, prose(700, 20) + " quibblewort " + prose(701, 20))]
    rows += [row(50 + i, prose(300 + i, 60) + " writes to") for i in range(200)]
    texts = {r[0]: r[1] for r in rows}
    out = {r.doc_id: r for r in P.personal_data(table(rows)).collect()}
    named = {i: [texts[i][t.start : t.end].lower() for t in r.terms] for i, r in out.items()}
    assert all(named[i] == ["quibblewort"] * 2 for i in range(6)) and named[40] == ["quibblewort"]
    assert all("fizzlebaum" in named[20 + i] for i in range(2))
    assert out[40].text == texts[40] and not out[40].base
    assert all(not named[50 + i] and out[50 + i].text is None for i in range(200))
    clean = {r.doc_id: r.sanitised for r in P.sanitised(table(rows)).collect()}
    assert sorted(clean) == [0, 1, 2, 3, 4, 5, 20, 21, 40] and not any("quibblewort" in t.lower() for t in clean.values())
