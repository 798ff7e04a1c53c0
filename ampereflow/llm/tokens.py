"""Byte-level BPE over whole texts, cached by word."""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import lru_cache
from pathlib import Path

import numpy as np

_DOUBLE = re.compile(r"\s\s")
_MARKS = ".,;:!?#$%&*|()\""


@lru_cache(maxsize=2)
def encoder(path: str):
    """tiktoken encoder over a rank file; strings of special tokens are ordinary text."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """Strings that a tokenizer file makes one id before any other rule."""
    return {t["content"]: t["id"] for t in json.loads(Path(tokenizer_path).read_text())["added_tokens"]}


class PieceCache(dict):
    """Text without white space inside, with at most one space before it -> its ids as little-endian 32-bit bytes."""

    def __init__(self, path: str, tokenizer_path: str | None = None, most: int = 100_000) -> None:
        super().__init__()
        self.encode, self.most = encoder(path).encode_ordinary, most
        added = added_tokens(tokenizer_path) if tokenizer_path else {}
        self.added = {k: array("I", [v]).tobytes() for k, v in added.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None

    def __missing__(self, piece: str) -> bytes:
        word = piece.rstrip(_MARKS)
        if word is not piece and word[-1:].isalpha():  # a run of letters ends before a mark
            ids = self[word] + self[piece[len(word) :]]
        else:
            ids = array("I", self.encode(piece)).tobytes()
        if len(piece) < 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The ids of a whole text; added tokens stand for themselves and part the text."""
        if self.split and any(x in text for x in self.added):
            return b"".join(self.added[x] if k % 2 else self._plain(x) for k, x in enumerate(self.split(text)))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        """Pieces of the split pattern never run on from other characters into white space, so where white space stands alone the
        text may be cut before each space and around each line break."""
        if not text:
            return b""
        if _DOUBLE.search(text):
            return np.asarray(self.encode(text), dtype="<u4").tobytes()
        first, *rest = text.split("\n")
        return b"".join([self._line(first), *(self["\n"] + self._line(x) for x in rest)])

    def _line(self, line: str) -> bytes:
        if not line:
            return b""
        first, *rest = line.split(" ")
        get = self.__getitem__
        return (get(first) if first else b"") + b"".join(map(get, [" " + x for x in rest]))


@lru_cache(maxsize=2)
def piece_cache(path: str, tokenizer_path: str | None = None) -> PieceCache:
    return PieceCache(path, tokenizer_path)
