"""Whole texts to token ids with a given, never trained, tokenizer file.

Byte-level BPE works on pre-tokens, and none of them reaches over a single blank between words, nor from a letter into a mark.
Texts are split there; each distinct word is encoded by the tokenizers library's model once per Python worker and
remembered, and ids are joined again: the same ids as from the whole text, at a fraction of its cost.  A text with other
white space around its blanks, and any text under another kind of tokenizer, goes through the library whole.
"""

from __future__ import annotations

import json
import os
import string
import sys
from array import array

import numpy as np

#: Words, and as many other parts of texts at most, remembered by one Python worker: some 150 MB.
REMEMBERED = 600_000

_MARKS = string.punctuation
_encoders: dict[str, Encoder] = {}


class _Letters(dict):
    """How byte-level pre-tokenizing writes a character, asked of the library once per character."""

    def __init__(self, pre):
        super().__init__()
        self.pre = pre

    def __missing__(self, code: int) -> str:
        self[code] = "".join(x for x, _ in self.pre.pre_tokenize_str(chr(code)))
        return self[code]


class _Whole(Exception):
    """A text that has to go through the library whole."""


class _Words(dict):
    """Ids of words that follow a blank, each asked of the encoder once."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            x = self.encoder._letters(f" {word}")
        elif not word or word[0].isspace() or word[-1].isspace():
            raise _Whole
        else:
            x = self.encoder._word(f" {word}")
        if len(self) < REMEMBERED:
            self[word] = x
        else:
            self.encoder.unremembered += 1
        return x


class Encoder:
    """Ids of texts as little-endian bytes, 2 per id while the vocabulary has no more than 65,536 entries, else 4."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4")
        kind = json.loads(self.tokenizer.to_str())
        pre = kind["pre_tokenizer"] or {}
        #: Strings that the library takes out of a text as one id, before it cuts words: texts with one are encoded whole.
        self.added = tuple(t["content"] for t in kind["added_tokens"])
        self.cuts = (kind["normalizer"] is None and kind["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel"
                     and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.model = self.tokenizer.model
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize] if sys.byteorder == "little" else None
        self.letters = _Letters(ByteLevel(add_prefix_space=False, use_regex=False))
        self.words = _Words(self)
        self.parts: dict[str, bytes] = {}
        self.unremembered = 0

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, text: str) -> bytes:
        """A pre-token of letters, with or without a blank before them."""
        # An ASCII letter stands for itself.
        shown = self.letters[32] + text[1:] if text[0] == " " and text.isascii() else text.translate(self.letters)
        ids = [t.id for t in self.model.tokenize(shown)]
        return array(self.code, ids).tobytes() if self.code else self._pack(ids)

    def _part(self, text: str) -> bytes:
        """A short text, or marks."""
        x = self.parts.get(text)
        if x is None:
            x = self._whole(text)
            if len(self.parts) < REMEMBERED:
                self.parts[text] = x
            else:
                self.unremembered += 1
        return x

    def _word(self, text: str) -> bytes:
        """A word with the blank before it, if any; neither end is other white space."""
        body = text.rstrip(_MARKS)
        if body.lstrip(" ").isalpha():
            if len(body) == len(text):
                return self._letters(text)
            # The word without its marks is a word of its own.
            return (self.words[body[1:]] if body[0] == " " and body[1] != " " else self._letters(body)) + self._part(text[len(body):])
        lines = text.split("\n")
        if len(lines) > 1 and all(x.strip() and x[-1:].strip() for x in lines) and all(x[0].strip() for x in lines[1:]):
            # A line end between non-blank characters is a pre-token of its own.
            return self._part("\n").join([self._word(x) for x in lines])
        return self._whole(text)

    def encode(self, text: str) -> bytes:
        if not self.cuts or not text or any(a in text for a in self.added):
            return self._whole(text)
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self._whole(text)
        if self.unremembered > 40 * REMEMBERED:  # the texts may have become others
            self.words.clear()
            self.parts.clear()
            self.unremembered = 0
        try:
            return self._word(first) + b"".join(map(self.words.__getitem__, rest))
        except _Whole:
            return self._whole(text)

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, dtype=self.dtype)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
