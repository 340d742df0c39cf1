import hashlib
import os
import subprocess
import sys
from functools import cache

import numpy as np
import pytest
from backdrop.llm import bpe_chunks as B
from backdrop.llm import token_counts as C
from backdrop.llm import tokens as T
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import awkward, prose

ODD = ["", "a", "  ", "a  b \n\n c\t d", "x" * 70000 + " y " + "z" * 70000, "<|endoftext|> hi<|endoftext|>", "it's  we'll go\u0085x  y", " lead",
       "trail  \n", "a᠎b ​ c", "\t\t \n x", "end\r\n", "é" * 30000, "a\x1c b", prose(3, 5000)]


@pytest.fixture(scope="module")
def spec():
    return T.tokenizer_text(T.default_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.default_path())


def test_odd_texts(spec, library):
    coder, decoder = B.ChunkEncoder(spec), T.ByteDecoder(spec)
    for text, ids in zip(ODD, coder.encode(ODD), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert decoder.decode(ids).decode(errors="replace") == library.decode(ids.tolist(), skip_special_tokens=False) == text


@cache
def both():
    return Tokenizer.from_file(T.default_path()), B.ChunkEncoder(T.tokenizer_text(T.default_path()))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'sé你 \n\t\r  \x1c1,.<|endoftext|>"), max_size=60))
def test_any_text(text):
    library, coder = both()
    assert coder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 你\n\x1c\x1f\x85\u3000."), max_size=80), st.integers(1, 9))
def test_slices_end_at_safe_boundaries(text, most):
    parts = list(T.slices(text, most))
    assert "".join(parts) == text
    assert [p for x in parts for p in T.pieces(x)] == T.pieces(text)


def test_ids_of_any_order_decode_as_the_library_has_it(spec, library):
    ids = np.random.default_rng(0).integers(0, 50257, 400)
    assert T.ByteDecoder(spec).decode(ids).decode(errors="replace") == library.decode(ids.tolist(), skip_special_tokens=False)


def test_cuts_follow_the_content():
    passage = prose(5, 3000)
    a, b = (prose(1, 50) + " " + passage).encode(), (prose(2, 333) + " " + passage).encode()
    split = lambda data: [data[s:e] for s, e in zip([0, *B.cuts(data)], B.cuts(data), strict=False)]
    assert b"".join(split(a)) == a
    shared = set(split(a)) & set(split(b))
    assert sum(map(len, shared)) > 0.9 * len(passage.encode())
    assert all(len(x) <= B.CHUNK_MAX + 4 for x in split(b"q" * 300_000))


def test_chunks_are_encoded_once(spec, monkeypatch):
    coder = B.ChunkEncoder(spec)
    seen = []
    learn = coder.encoder.learn
    monkeypatch.setattr(coder.encoder, "learn", lambda found: (seen.append(sum(map(len, found))), learn(found))[1])
    text = prose(9, 20_000)
    coder.encode([text])
    coder.encode([text + " more"])
    assert seen[1] < 0.2 * seen[0]


def test_batches_are_balanced(monkeypatch):
    monkeypatch.setattr(C, "BATCH_BYTES", 1000)
    texts = ["", prose(1, 2000), "a b", prose(2, 3), "é ü " * 900] * 3
    batches = list(C.balanced(texts))
    assert all(sum(len(p.encode()) for _, p in b) < 1100 for b in batches)
    assert sum(sum(len(p.encode()) for _, p in b) > 700 for b in batches) > len(batches) - 2
    again = ["".join(p for b in batches for j, p in b if j == i) for i in range(len(texts))]
    assert again == texts


MEMORY = """
import resource, sys
from backdrop.llm import bpe_chunks, token_counts, tokens
import numpy as np
import pyarrow as pa
kind, spec = sys.argv[1], tokens.tokenizer_text(tokens.default_path())
rng = np.random.default_rng(0)
words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(200_000)]
text = " ".join(words[i] for i in rng.integers(0, len(words), 1_400_000))[: 8 << 20]
text = text[: 4 << 20] + "\x1c" + text[4 << 20 :] if kind == "control" else text
batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
for run in (bpe_chunks._encode(spec, True), token_counts._lengths(spec)):
    assert sum(b.num_rows for b in run([batch])) == 1
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


@pytest.mark.parametrize("kind", ["words", "control"])
def test_memory_of_a_very_long_text(kind):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", MEMORY, kind], cwd=root, capture_output=True, text=True, check=True, timeout=300)
    assert int(done.stdout) < 600


def test_queries_on_awkward_rows(docs, empty, library):
    want = {}
    for r in awkward():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], r[1]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())
    out = B.encode_documents(docs, T.default_path(), digest=True).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == sorted(want[r[0], r[1]] for r in awkward())
    plain = B.encode_documents(docs, T.default_path()).collect()
    assert sorted(r.decoded for r in plain) == sorted(r[1] or "" for r in awkward())
    counts = C.token_counts(docs, T.default_path()).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in counts) == sorted((len((r[1] or "").encode()), want[r[0], r[1]][0]) for r in awkward())
    assert B.encode_documents(empty, T.default_path()).count() == 0 and C.token_counts(empty, T.default_path()).count() == 0
