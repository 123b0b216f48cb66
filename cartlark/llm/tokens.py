"""Token ids of whole texts by a public tokenizer file, with the pieces of a text memoised.

For the two kinds of pre-tokenizer below a text can be cut after every run of non-spaces:
no match of their patterns reaches from a non-space into the white space behind it, and
what a match takes of the white space depends on that run and the next character alone.
Each distinct piece is then encoded once per Python worker.  Any other tokenizer file, and
any text with the characters on which definitions of white space differ, is encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from struct import pack

import numpy as np

#: Latin letters that are letters in every Unicode version and keep their form under NFC.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = re.compile(f"(\\s*)([{_LETTER}]+)([.,;:!?]*)")
_PIECE = re.compile(r"\s*\S+|\s+")
_UNSURE = re.compile("[\\x1c-\\x1f]")
#: Pieces held by a worker at most.  A full memo keeps what it has, as common pieces come
#: early, and starts anew after so many misses, in case the texts have changed.
MEMO_PIECES = 300_000
MEMO_MISSES = 4_000_000


def fingerprint(path: str) -> str:
    """Digest of the tokenizer file and the version of the library that reads it."""
    import tokenizers

    with open(path, "rb") as file:
        digest = hashlib.sha256(file.read())
    digest.update(tokenizers.__version__.encode())
    return digest.hexdigest()


class Memo(dict):
    """At most ``MEMO_PIECES`` remembered values of ``encode``."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.misses = encode, 0

    def __missing__(self, key: str) -> bytes:
        value = self.encode(key)
        self.misses += 1
        if self.misses > MEMO_MISSES:
            self.clear()
            self.misses = 0
        if len(self) < MEMO_PIECES:
            self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: each byte that is no
    printable Latin-1 character gets the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


def _spelled() -> dict[int, str]:
    """The stand-ins of the UTF-8 bytes of the characters of simple pieces."""
    stand_in = byte_letters()
    return {c: "".join(stand_in[b] for b in chr(c).encode()) for c in range(256)}


class PieceEncoder:
    """``ids(text)``: the little-endian unsigned 32-bit ids of a text as bytes."""

    def __init__(self, path: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.drops_space = _drops_space(spec)
        self.by_piece = self.drops_space or _byte_level(spec)
        self.model = self.tokenizer.model
        self.letters = _spelled()
        self.memo, self.marks = Memo(self._piece), Memo(self._whole)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        """One match of the pattern: letters, with a space before them where that counts."""
        plain = part if part.isascii() and part[0] != " " else part.translate(self.letters)
        ids = [token.id for token in self.model.tokenize(plain)]
        return pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        simple = _SIMPLE.fullmatch(piece)
        if simple is None:
            return self._whole(piece)
        space, letters, end = simple.groups()
        if not self.drops_space and space not in ("", " "):
            return self._whole(piece)
        if end:  # the word itself is held once, under its own piece
            return self.memo[piece[: -len(end)]] + self.marks[end]
        return self._part(letters.lower() if self.drops_space else piece)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_piece or _UNSURE.search(text):
            return self._whole(text)
        pieces = text.split() if self.drops_space else _PIECE.findall(text)
        return b"".join(map(self.memo.__getitem__, pieces))


def _byte_level(spec: dict) -> bool:
    step = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and step.get("type") == "ByteLevel"
        and step.get("use_regex", True)
        and not step.get("add_prefix_space", True)
        and _plain_added(spec)
    )


def _drops_space(spec: dict) -> bool:
    """Lower-cased text whose pattern takes letter runs, digits and other runs, no space."""
    pattern = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    normal = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": pattern}
        and steps[0]["invert"]
        and steps[0]["behavior"] == "Removed"
        and not steps[1]["use_regex"]
        and not steps[1]["add_prefix_space"]
        and _plain_added(spec)
    )


def _plain_added(spec: dict) -> bool:
    return all(
        not (token["lstrip"] or token["rstrip"] or token["single_word"])
        and not re.search(r"\s", token["content"])
        for token in spec.get("added_tokens", [])
    )


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and file; workers are reused from task to task."""
    return PieceEncoder(path)
