"""The tokenizers library, called once per distinct word of a task.

Both vocabularies encode the matches of their split pattern one by one, so a
text's ids are those of its words in a row as long as no match crosses a cut.
Words made of Latin letters and closing marks skip the library's splitter and go
straight to its BPE model; everything else takes the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array

#: Words that a worker keeps, and as many from before that it still knows.
CACHED_WORDS = 150_000

#: Letters, and ASCII marks after them: a match of their own. An apostrophe may
#: begin a match with letters, and some patterns count _ as a letter.
_LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-^`{-~]*)")


def byte_chars() -> dict[int, str]:
    """Character that stands for each byte in a byte-level vocabulary: itself
    where it is visible in Latin-1, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_CHARS = byte_chars()
_SPACE = _BYTE_CHARS[32]


def byte_level(text: str) -> str:
    if text.isascii() and text.isalpha():
        return text
    return text.encode().decode("latin-1").translate(_BYTE_CHARS)


def single_threaded() -> None:
    """One thread per task; Spark runs the tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class _Words(dict):
    """Ids by word; a word that is looked up and not there is learned."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        return self.learn(word)


class WordEncoder:
    """Ids of words as little-endian unsigned 32-bit integers.

    With ``spaced``, words are those after a single space, which belongs to the
    word's first match; ``start`` encodes a text's first word. Without, white
    space belongs to no match and case does not matter.
    """

    def __init__(self, tokenizer, spaced: bool, cached: int = CACHED_WORDS):
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.spaced = spaced
        self.cached = cached
        self.known: dict[str, bytes] = _Words(self._learn)
        self.before: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}
        self.marks = {m: self.whole(m) for m in ".,;:!?"}

    def encode(self, words: list[str]) -> bytes:
        """Ids of the words in a row."""
        if len(self.known) >= self.cached:
            self.before, self.known = self.known, _Words(self._learn)
        return b"".join(map(self.known.__getitem__, words))

    def start(self, text: str) -> bytes:
        """Ids of words that no space precedes."""
        ids = self.starts.get(text)
        if ids is None:
            if len(self.starts) >= self.cached // 4:
                self.starts.clear()
            m = _LATIN.fullmatch(text) if self.spaced else None
            ids = self._latin(byte_level(m[1]), m[2]) if m else self.whole(text)
            self.starts[text] = ids
        return ids

    def _latin(self, letters: str, marks: str) -> bytes:
        """Ids of letters, as the model's characters, and of the marks after them."""
        ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return ids + (self.marks.get(marks) or self.start(marks)) if marks else ids

    def _learn(self, word: str) -> bytes:
        """The common case, ASCII letters with or without a closing mark, goes
        straight to the model."""
        known, before = self.known, self.before
        ids = before.get(word)
        if ids is None:
            mark = self.marks.get(word[-1:], b"")
            letters = word[:-1] if mark else word
            if not (letters.isascii() and letters.isalpha()):
                ids = self._other(word)
            else:
                ids = (known.get(letters) or before.get(letters)) if mark else None
                if ids is None:
                    plain = _SPACE + letters if self.spaced else letters.lower()
                    ids = array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()
                    if mark:
                        known[letters] = ids
                ids += mark
        known[word] = ids
        return ids

    def _other(self, word: str) -> bytes:
        m = _LATIN.fullmatch(word)
        if not m:
            return self._broken(word)
        letters, marks = m.groups()
        text = _SPACE + byte_level(letters) if self.spaced else byte_level(letters.lower())
        return self._latin(text, marks)

    def _broken(self, word: str) -> bytes:
        """Ids of a word that is not plain; a lone line feed between two
        non-spaces is a match of its own."""
        if not self.spaced:
            return self.whole(word)
        if word.count("\n") == 1:
            left, _, right = word.partition("\n")
            if left and right and not left[-1].isspace() and not right[0].isspace():
                return self.known[left] + self.start("\n") + self.start(right)
        return self.whole(" " + word)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()
