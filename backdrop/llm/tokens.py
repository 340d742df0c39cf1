"""Byte-level BPE by pieces.

A *safe boundary* of a text lies between a character that is not white space
and one that is. The pre-tokeniser of a byte-level BPE never lets a token
cross it from either side: a pre-token holds white space only at its start,
and what it looks ahead at is white space only. The ids of a text are
therefore the ids of its pieces between safe boundaries, put in a row. White
space is the tokeniser's class, written out in ``WHITE``; Python's own has the
control characters U+001C to U+001F besides.

Pieces of running text repeat a lot, so their ids are remembered, up to a
number of bytes. Long texts are worked on in slices between safe boundaries.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

# White space as the tokeniser has it (the Unicode property), as a class of a pattern.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_WORD = re.compile(f"[^{WHITE}]+")
_BOUNDARY = re.compile(f"[^{WHITE}](?=[{WHITE}])")
_BOUNDARY_BACK = re.compile(f"[{WHITE}](?=[^{WHITE}])")
_IN_ROW = re.compile(f"[{WHITE}].*[^{WHITE}]", re.DOTALL)

# Bytes of remembered pieces of a task, as estimated with PIECE_BYTES for each
# piece beside its text and ids. The half used last stays when they are reached.
MEMO_BYTES = 160 << 20
PIECE_BYTES = 180
# The longest piece that is remembered.
MEMO_CHARS = 48
# Characters of new pieces that are encoded in one row, and in one call.
ROW_CHARS = 1 << 15
CALL_CHARS = 1 << 19
# Characters of a long text that are worked on at once, unless it has no safe boundary.
SLICE_CHARS = 1 << 18


def pieces(text: str) -> list[str]:
    """The pieces of a text between its safe boundaries."""
    return _PIECE.findall(text)


def slices(text: str, most: int | None = None, boundary: re.Pattern = _BOUNDARY) -> Iterator[str]:
    """The text in parts of about ``most`` characters that end at safe boundaries; no part for an empty text."""
    most = most or SLICE_CHARS
    at = 0
    while len(text) - at > most:
        cut = boundary.search(text, at + most - 1)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    if at < len(text):
        yield text[at:] if at else text


def safe_ends(text: str) -> tuple[int, int] | None:
    """The first and the last safe boundary inside a text; None if it has none."""
    first = _BOUNDARY.search(text)
    if first is None:
        return None
    return first.end(), len(text) - _BOUNDARY_BACK.search(text[::-1]).end()


def words(text: str) -> list[str]:
    """The stretches of a text without white space."""
    return _WORD.findall(text)


def plain_tokenizer(tokenizer_json: str):
    """The tokenizers library's reading of a file, without truncation and padding, in the task's own thread."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class PieceMemo:
    """What is made of pieces (their ids), each distinct one once while it is remembered; at most about ``MEMO_BYTES`` are."""

    def __init__(self) -> None:
        self.memo: dict = {}
        self.older: dict = {}
        self.held = 0

    def learn(self, found: Iterable[str]) -> dict:
        """What is made of all of ``found`` at least; valid until the next call."""
        if self.held > MEMO_BYTES // 2:
            # What was of use lately stays for another round.
            self.memo, self.older, self.held = {}, self.memo, 0
        memo, older = self.memo, self.older
        long: dict = {}
        part: list[str] = []
        again: list[str] = []
        held = 0
        for p in [p for p in dict.fromkeys(found) if p not in memo]:
            if p in older:
                again.append(p)
                continue
            part.append(p)
            held += len(p)
            if held >= CALL_CHARS:
                long |= self._remember(part)
                part, held = [], 0
        if part:
            long |= self._remember(part)
        known = {p: older[p] for p in again}
        self.held += self._size(known)
        memo.update(known)
        return memo | long if long else memo

    def _remember(self, new: list[str]) -> dict:
        """Encode ``new``; those too long to be remembered are returned."""
        known = self._encode(new)
        long = {p: known.pop(p) for p in new if len(p) > MEMO_CHARS}
        self.held += self._size(known)
        self.memo.update(known)
        return long

    def _encode(self, new: list[str]) -> dict:
        raise NotImplementedError

    def _size(self, known: dict) -> int:
        """Estimated bytes of what is remembered."""
        return PIECE_BYTES * len(known) + sum(map(len, known)) + sum(map(len, known.values()))


class PieceEncoder(PieceMemo):
    """Ids (little-endian unsigned 32-bit) of pieces under a byte-level BPE.

    New pieces are encoded many at a time: pieces that begin with white space
    and end without keep their safe boundaries when they stand in a row, so
    one call encodes a text made of them, and the ids are dealt back to the
    pieces by their length in bytes.
    """

    def __init__(self, tokenizer_json: str, special: bool = True) -> None:
        super().__init__()
        self.tokenizer = plain_tokenizer(tokenizer_json)
        # Without ``special``, special strings inside texts are plain text.
        self.tokenizer.encode_special_tokens = not special
        self.decoder = ByteDecoder(tokenizer_json)

    def _encode(self, new: list[str]) -> dict[str, bytes]:
        rows: list[list[str]] = []
        alone: list[str] = []
        held = ROW_CHARS
        for p in new:
            if _IN_ROW.fullmatch(p):
                if held + len(p) > ROW_CHARS:
                    rows.append([])
                    held = 0
                rows[-1].append(p)
                held += len(p)
            else:
                alone.append(p)
        known = {}
        # A whole text in one piece is encoded by itself, so that its tokens' records go before the next.
        for some in (alone,) if sum(map(len, alone)) < CALL_CHARS else ([p] for p in alone):
            made = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            known.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(some, made, strict=True))
        made = self.tokenizer.encode_batch_fast(["".join(r) for r in rows], add_special_tokens=False)
        for row, e in zip(rows, made, strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum(self.decoder.length[ids])
            want = np.cumsum([len(p.encode()) for p in row])
            cut = np.searchsorted(ends, want)
            if not np.array_equal(ends[cut], want):
                raise ValueError("a token crosses a safe boundary: this tokenizer is not byte-level BPE")
            flat, at = ids.tobytes(), ((cut + 1) * 4).tolist()
            known.update(zip(row, (flat[i:j] for i, j in zip([0, *at], at, strict=False)), strict=True))
        return known


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for U+0100 onwards.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTable:
    """Bytes of ids."""

    def __init__(self, table: list[bytes]) -> None:
        self.length = np.array([len(t) for t in table], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.blob = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        end = np.cumsum(n)
        if not len(ids):
            return b""
        at = np.repeat(self.start[ids] - (end - n), n)
        at += np.arange(end[-1])
        return self.blob[at].tobytes()


class ByteDecoder(ByteTable):
    """Bytes of the ids of a byte-level BPE, special tokens included."""

    def __init__(self, tokenizer_json: str) -> None:
        spec = json.loads(tokenizer_json)
        symbols = byte_symbols()
        content = {i: bytes(symbols[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        content |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        super().__init__([content.get(i, b"") for i in range(max(content) + 1)])


def tokenizer_text(path: str) -> str:
    """The tokenizer file, read on the driver; tasks get its text (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
