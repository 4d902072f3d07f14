"""Token ids of whole texts by a public tokenizer file, with words remembered.

A tokenizer splits a text into words before it merges anything, so the ids of a text are
the ids of its words end to end. Words repeat, so a process keeps the ids of those it has
met, up to a bound, and asks the tokenizer only for new ones. A text whose white space
does not cut cleanly, or that holds a control string of the file, goes to the tokenizer
whole. Results equal the tokenizer's own.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Callable

REMEMBERED = 1_000_000
_SPACE_RUN = re.compile(r"[^\S \n]|[ \n]{2}").search
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"([ \n]?)([{_LETTERS}]+)([!#-&(-/:-@\\[-^`{{-~]*)").fullmatch


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Words(dict):
    """Ids, as little-endian 32-bit bytes, of words; a new word is asked for once."""

    def __init__(self, ask: Callable[[str], bytes]):
        super().__init__()
        self.ask = ask

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[word] = self.ask(word)
        return ids


class Encoder:
    """``encode(text)`` gives the ids of a text as little-endian unsigned 32-bit bytes.

    With ``controls``, control strings in a text get their own ids, as the library gives
    them by default; without, they are encoded like other text.
    """

    def __init__(self, path: str, controls: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not controls
        self.controls = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()] if controls else []
        model = self.tokenizer.model
        model._resize_cache(0)
        self.merge, self.letters = model.tokenize, _byte_letters()
        self.keeps_space = self.tokenizer.normalizer is None
        self.first = _Words(self._word)
        self.rest = _Words(self._spaced) if self.keeps_space else self.first
        self.marks = _Words(self._merged)

    def _merged(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1")
        return array("I", [token.id for token in self.merge(word.translate(self.letters))]).tobytes()

    def _spaced(self, word: str) -> bytes:
        """A word after a space, or one that a line feed opens."""
        return self._word(word if word[:1] == "\n" else " " + word)

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        plain = _PLAIN(word)
        if plain is None or plain[1] == "\n":
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        space, letters, marks = plain.groups()
        if not self.keeps_space:
            letters = letters.lower()
            return (self.first[letters] if letters != word else self._merged(letters)) + (self.marks[marks] if marks else b"")
        if not marks:
            return self._merged(word)
        return (self.rest if space else self.first)[letters] + self.marks[marks]

    def encode(self, text: str) -> bytes:
        if any(map(text.__contains__, self.controls)):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if not self.keeps_space:
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))
        if _SPACE_RUN(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.first[first] + b"".join(map(self.rest.__getitem__, rest))


def encoder(path: str) -> Encoder:
    """The process's encoder for a file, kept between tasks."""
    kept = sys.modules.setdefault("_tidemark_encoders", types.ModuleType("_tidemark_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = Encoder(path, controls=True)
    return kept.__dict__[path]
