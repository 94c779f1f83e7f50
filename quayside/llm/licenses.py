"""License notices by exact phrases and fuzzy short-notice search.

Texts are brought to a normal form: ASCII lower case, words of ASCII letters,
digits and all other characters from 0x80, one space between. Exact phrases are
found there by whole words. For the fuzzy notices the pigeonhole principle gives
exact seeds: a notice with up to k edits (insertions, deletions, substitutions of
a byte) is cut into k + 1 pieces, one of which stands unchanged. One automaton
finds the pieces of all notices in one pass. A find says where the notice begins and ends, up to k
bytes; each run of whole words between such places is given to the regex library's bounded-error
matching (``(?:notice){e<=k}``), in its own region, so every match within the bound is seen and
none hides another. The spans are whole words; of a notice's overlapping matches the best stands.

Every document is searched in its whole length, and the work stays in one pass over
the rows, without a shuffle; a third of all rows of one source is a third of the tasks.

Nulls: a null text is empty: no words, no places, empty labels, score 0. A null
doc_id passes through. Repeated rows give equal rows; a very long text is scanned whole. Empty tables give no
rows. Of the input only doc_id and text are read: other columns cannot clash.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import pick, steps, table, text_bytes

#: Lower case, and a space for every ASCII character outside a word.
_NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if chr(c).isdigit() or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


class Notice(NamedTuple):
    label: str
    text: str
    edits: int


#: Opening or title words of well-known notices, in the normal form.
NOTICES = (
    Notice("gpl", "gnu general public license", 3),
    Notice("gpl", "general public license", 2),
    Notice("reserved", "all rights reserved", 2),
    Notice("apache", "licensed under the apache license", 3),
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("public-domain", "released into the public domain", 3),
)


class Scanner:
    """Built once in each task from the notices."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        import ahocorasick

        self.notices, pieces = notices, {}
        for k, n in enumerate(notices):
            size, cuts = len(n.text), n.edits + 1
            bounds = [size * c // cuts for c in range(cuts + 1)]
            for a, b in zip(bounds, bounds[1:]):
                pieces.setdefault(n.text[a:b], []).append((k, a))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()
        self.patterns = [[regex.compile(f"(?:{regex.escape(n.text)}){{e<={e}}}") for e in range(n.edits + 1)] for n in notices]

    def edits(self, k: int, text: str, a: int, b: int) -> int | None:
        """The fewest edits that make notice k of ``text[a:b]``, if they are within its bound."""
        *fewer, widest = self.patterns[k]
        if not widest.fullmatch(text, a, b):
            return None
        return next((e for e, p in enumerate(fewer) if p.fullmatch(text, a, b)), len(fewer))

    def fuzzy(self, text: str) -> list[tuple[str, int, int, int]]:
        """``(label, start, end, edits)`` of the matches in a normal form, offsets in it. Each find is verified by itself;
        of a notice's matches that overlap the one of the fewest edits stands, then the first."""
        seen: dict[int, dict[tuple[int, int], int | None]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            begin = last + 1 - size
            for k, offset in owners:
                n, known = self.notices[k], seen.setdefault(k, {})
                first, end = begin - offset, begin - offset + len(n.text)
                for a in range(max(0, first - n.edits), min(begin, first + n.edits) + 1):
                    if a and text[a - 1] != " ":
                        continue
                    for b in range(max(last + 1, end - n.edits), min(len(text), end + n.edits) + 1):
                        if (b == len(text) or text[b] == " ") and (a, b) not in known:
                            known[a, b] = self.edits(k, text, a, b)
        out = set()
        for k, known in seen.items():
            found = {at: edits for at, edits in known.items() if edits is not None}
            starts, ends = [], []  # of the matches that stand, ascending; they are disjoint
            for (a, b), edits in sorted(found.items(), key=lambda x: (x[1], x[0])):
                i = bisect.bisect_left(ends, a + 1)
                if i == len(starts) or starts[i] >= b:
                    starts.insert(i, a)
                    ends.insert(i, b)
                    out.add((self.notices[k].label, a, b, edits))
        return sorted(out, key=lambda x: (x[1], x[2], x[0], x[3]))


def exact(text: bytes) -> list[tuple[str, int]]:
    """``(label, first word)`` of all base phrases in a normal form."""
    out, padded = [], b" " + text + b" "
    for phrase, label in BASE:
        needle = b" " + phrase.encode() + b" "
        at, word, seen = padded.find(needle), 0, 0
        while at >= 0:
            word, seen = word + padded.count(b" ", seen, at), at
            out.append((label, word))
            at = padded.find(needle, at + 1)
    return out


_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32())])
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
    ("spans", pa.list_(_SPAN)), ("score", pa.float64()),
])
_DDL = (
    "doc_id long, n_words long, base array<struct<label:string,word:long>>, "
    "spans array<struct<label:string,first_word:long,n_words:long,edits:int>>, score double"
)


def scan_text(data: bytes, scanner: Scanner) -> tuple[int, list, list, float]:
    """``(n_words, base places, fuzzy spans, score)``; the score is 1 for an exact phrase, else what
    the best fuzzy match keeps of its notice's bytes."""
    words = data.translate(_NORMAL).split(b" ")
    words = [w for w in words if w]
    normal = b" ".join(words)
    base = exact(normal)
    text = normal.decode("latin-1")  # a character for each byte
    spans, score = [], 1.0 if base else 0.0
    for label, a, b, edits in scanner.fuzzy(text):
        spans.append({"label": label, "first_word": text.count(" ", 0, a), "n_words": text.count(" ", a, b) + 1, "edits": edits})
        score = max(score, 1.0 - edits / max(b - a, edits, 1))
    return len(words), [{"label": x, "word": w} for x, w in base], spans, score


def _scan(notices: tuple[Notice, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for rb in steps(batches):
            buf, offs = text_bytes(rb.column("text"))
            data = buf.tobytes()
            got = [scan_text(data[a:b], scanner) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            columns = [rb.column("doc_id"), *[pa.array([g[k] for g in got], _SCHEMA.field(k + 1).type) for k in range(4)]]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    return run


def license_scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """``doc_id, n_words, base, spans, score``: exact places and fuzzy spans, in words of the normal form."""
    return pick(docs, doc_id="long", text="string").mapInArrow(_scan(notices), _DDL)


def q_op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    labels = lambda *of: F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*[F.col(f"{x}.label") for x in of]))))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        labels("base").alias("base_labels"), labels("base", "spans").alias("labels"), "score",
        F.size("spans").cast("long").alias("n_spans"),
    )
