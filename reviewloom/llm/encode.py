"""Encoding whole texts with a public byte-level BPE vocabulary, inside tasks."""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k"
#: Where a text may be cut without changing its ids: at single spaces. A run of white space that
#: holds a space before more white space is one token or more across the cut, so such texts, and
#: those that may hold a special token, are encoded whole.
_UNCUTTABLE = re.compile(r" (?:\s|\Z)|<\|")


class Encoder:
    """Ids of ``tokenizers`` for a text, as little-endian unsigned 32-bit numbers.

    Words repeat, so the ids of each space-led word are kept, up to ``words`` of them (the
    first seen, which hold the frequent ones); others are encoded each time.
    """

    def __init__(self, vocabulary: str = VOCABULARY, words: int = 300_000):
        self._whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encode = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = array("I", encode(" " + word)).tobytes()
                if len(self) < words:
                    self[word] = ids
                return ids

        self._encode, self._words = encode, Words()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _UNCUTTABLE.search(text):
            return array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        return array("I", self._encode(first)).tobytes() + b"".join(map(self._words.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(vocabulary)
