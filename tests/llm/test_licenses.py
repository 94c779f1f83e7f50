import random
import re

from quayside.llm.licenses import BASE, NOTICES, Scanner, license_scan, scan_text
from tests.llm.conftest import awkward_rows, frame, prose


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)
    places = sorted((i, label) for phrase, label in BASE for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p)
    return len(w), places


def rows():
    rng, out = random.Random(8), awkward_rows()
    for k in range(40):
        parts = prose(300 + k, 30).split()
        for phrase, _ in rng.sample(BASE, rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts)), phrase.upper().replace(" ", rng.choice([" ", " - ", "\n", ", "])))
        out.append((400 + k, " ".join(parts), "en", "a", 0))
    return [*out, (500, "CC BY cc by, ccc by cc-by; éCC BY", "en", "a", 0), (501, "All rights\nreserved.", "en", "a", 0)]


def test_base_places_match_brute_force(spark):
    got = [(r["doc_id"], r["n_words"], sorted((p["word"], p["label"]) for p in r["base"])) for r in license_scan(frame(spark, rows())).collect()]
    assert sorted(got, key=str) == sorted([(r[0], *brute(r[1])) for r in rows()], key=str)


def test_edits_within_the_bound_are_found():
    rng, scanner = random.Random(2), Scanner()
    for notice in NOTICES:
        for edits in range(notice.edits + 1):
            for _ in range(20):
                s = list(notice.text)
                for _ in range(edits):
                    at = rng.randrange(1, len(s) - 1)
                    kind = rng.randrange(3)
                    if kind == 0:
                        s[at] = "q"
                    elif kind == 1:
                        s.insert(at, "q")
                    else:
                        del s[at]
                text = "some words " + " ".join("".join(s).split()) + " more words"
                spans = [x for x in scan_text(text.encode(), scanner)[2] if x["label"] == notice.label]
                assert spans and min(x["edits"] for x in spans) <= edits + 1, (notice, text)


def test_spans_and_scores():
    scanner = Scanner()
    n, base, spans, score = scan_text("See: Licenced under the Apache-License, Version 2.0".encode(), scanner)
    assert (n, base) == (9, []) and {"label": "apache", "first_word": 1, "n_words": 5, "edits": 1} in spans and 0.9 < score < 1
    assert scan_text(prose(3, 5000).encode(), scanner)[1:] == ([], [], 0.0)
    assert scan_text(b"", scanner) == (0, [], [], 0.0) and scan_text(b"all rights reserved", scanner)[3] == 1.0


def test_empty_table(nothing):
    assert license_scan(nothing).collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def every_match(text):
    """All runs of whole words within a notice's edits; of overlapping ones the best, then the first."""
    starts, out = [0] + [i + 1 for i, c in enumerate(text) if c == " "], set()
    stops = [i for i, c in enumerate(text) if c == " "] + [len(text)]
    for n in NOTICES:
        near = [(a, b) for a in starts for b in stops if abs(b - a - len(n.text)) <= n.edits]
        kept = []
        for edits, a, b in sorted((distance(n.text, text[a:b]), a, b) for a, b in near):
            if edits <= n.edits and all(b <= x or y <= a for x, y in kept):
                kept.append((a, b))
                out.add((n.label, a, b, edits))
    return sorted(out, key=lambda x: (x[1], x[2], x[0], x[3]))


def test_a_misspelt_notice_before_a_better_one_is_kept():
    spans = scan_text(b"x all rights reservd all rights reserved y", Scanner())[2]
    assert [(s["first_word"], s["n_words"], s["edits"]) for s in spans] == [(1, 3, 1), (4, 3, 0)]


def test_notices_close_together_match_brute_force():
    rng, scanner = random.Random(5), Scanner()
    for _ in range(60):
        parts = []
        for notice in rng.choices(NOTICES, k=rng.randrange(1, 5)):
            for _ in range(rng.randrange(1, 4)):
                s = list(notice.text)
                for _ in range(rng.randrange(notice.edits + 2)):
                    at = rng.randrange(len(s))
                    s[at : at + rng.randrange(2)] = rng.choice(["q", "", " ", "qu"])
                parts.append("".join(s))
                parts += rng.choice([[], [], ["a"], ["and the"], prose(rng.randrange(99), 3).split()])
        text = " ".join(" ".join(parts).split())
        assert scanner.fuzzy(text) == every_match(text), text
