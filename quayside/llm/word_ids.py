"""Token ids of whole texts by way of their distinct words, for the two byte-level tokenizers.

Both tokenizers cut a text into pieces before they merge bytes, and never within a run of letters or
across the start of a word. So a word's ids are learnt once and looked up from then on: plain Latin letters
with ASCII punctuation behind them as two pieces (the same letters in another word are not merged anew), every
other word by the whole tokenizer. A task's memory outlives it in its Python worker.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

import numpy as np

#: Distinct words of a generation whose ids a worker remembers (two generations of words, two of their pieces).
CACHE_WORDS = 300_000


class Recent(dict):
    """What ``make`` gives for a key, remembered for two generations: what is used stays, the rest is forgotten
    after ``most`` newer entries."""

    def __init__(self, most: int, make: Callable):
        super().__init__()
        self.most, self.make, self.older = most, make, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def age(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


class WordIds:
    """Ids, as little-endian 32-bit integers, of texts whose words are ``words(text)``; the end id follows each text."""

    #: ASCII punctuation, but the apostrophe, which can begin a piece of letters.
    MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27)
    #: Latin letters up to U+00FF.
    LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
    LETTERS = byte_letters()

    def __init__(self, tokenizer_json: str, end_id: int, most: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_str(tokenizer_json), struct.pack("<I", end_id)
        self.model = self.tokenizer.model
        self.known, self.stems, self.marks = Recent(most, self._word), Recent(most, self._stem), Recent(most, self._merged)

    def words(self, text: bytes) -> list[bytes]:
        """White space is dropped."""
        return text.split()

    def alone(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _merged(self, piece: bytes) -> bytes:
        """The ids of a piece that the tokenizer would not cut."""
        spelt = piece.decode("latin-1")
        ids = [t.id for t in self.model.tokenize(spelt if piece.isalpha() else spelt.translate(self.LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stem(self, letters: bytes) -> bytes:
        return self._merged(letters.decode().lower().encode())

    def _common(self, word: bytes, stems: Recent) -> bytes | None:
        """The ids of letters with or without punctuation behind them; None for other words."""
        letters = word.rstrip(self.MARKS)
        if not letters.isalpha() and not self.LATIN.fullmatch(letters):
            return None
        return stems[letters] if len(letters) == len(word) else stems[letters] + self.marks[word[len(letters) :]]

    def _word(self, word: bytes) -> bytes:
        ids = self._common(word, self.stems)
        return self.alone(word) if ids is None else ids

    def ids(self, data: bytes, offs: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, each with the end id, and where each document starts."""
        known = self.known.__getitem__
        parts = [b"".join(map(known, self.words(data[a:b]))) + self.end for a, b in zip(offs, offs[1:])]
        for memory in (self.known, self.stems, self.marks):
            memory.age()
        starts = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)))
        return np.frombuffer(b"".join(parts), "<u4"), starts


class SpacedWordIds(WordIds):
    """For the tokenizer that keeps case and white space: a word goes with the white space before it. The last blank of a
    run belongs to the word's letters, all before it is a piece of its own. A text with other white space than that of ASCII is
    one word, as its runs could span two."""

    #: Where white space is more than a blank or a line feed or two, words are found by ``UNIT``.
    RUNS = (b"  ", b" \n", b"\n ", b"\n\n\n", b"\t", b"\r", b"\x0b", b"\x0c")
    UNIT = re.compile(rb"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
    OTHER_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

    def __init__(self, tokenizer_json: str, end_id: int, most: int = CACHE_WORDS):
        super().__init__(tokenizer_json, end_id, most)
        self.bare, self.feed = Recent(most, self._merged), self._merged(b"\n")

    def words(self, text: bytes) -> list[bytes]:
        """Cut before each blank, which is left out, and each line feed; a word that begins with a blank stands for what follows it."""
        if not text.isascii() and self.OTHER_SPACE.search(text):
            return [b" " + text]
        if any(c in text for c in self.RUNS) or text.endswith(b"\n\n"):
            return [b" " + u for u in self.UNIT.findall(text)]
        first, *words = text.replace(b"\n", b" \n").split(b" ")
        return [b" " + first, *words] if first else words

    def _stem(self, letters: bytes) -> bytes:
        return self._merged(b" " + letters)

    def _word(self, word: bytes) -> bytes:
        first, rest = word[:1], word[1:]
        if first == b"\n":
            ids = self._common(rest, self.bare)
            return self.alone(word) if ids is None else self.feed + ids
        if first == b" ":
            ids = self._common(rest[1:], self.stems) if rest[:1] == b" " else self._common(rest, self.bare)
            return self.alone(rest) if ids is None else ids
        ids = self._common(word, self.stems)
        return self.alone(b" " + word) if ids is None else ids

    def ids(self, data: bytes, offs: list[int]) -> tuple[np.ndarray, np.ndarray]:
        self.bare.age()
        return super().ids(data, offs)


_workers: dict[tuple, WordIds] = {}


def remembered(kind: type[WordIds], tokenizer_json: str, end_id: int) -> WordIds:
    """The worker's own ``kind`` for this tokenizer, with all that earlier tasks have learnt."""
    key = (kind, tokenizer_json, end_id)
    if key not in _workers:
        _workers[key] = kind(tokenizer_json, end_id)
    return _workers[key]
