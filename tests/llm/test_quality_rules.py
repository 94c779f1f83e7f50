from collections import Counter

from quayside.llm.quality_rules import quality_rules
from tests.llm.conftest import awkward_rows, frame, prose, words


def base(text):
    text = text or ""
    w = words(text)
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(wins)
    hit = {j for i, x in enumerate(wins) if n[x] > 1 for j in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def brute(rows, max_docs, min_left=0.3, min_words=20):
    norm = lambda x: " ".join(words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)))
    held = [[norm(x) for x in (r[1] or "").split("\n") if words(x)] for r in rows]
    count = Counter((r[3], x) for r, h in zip(rows, held) for x in set(h))
    out = []
    for r, h in zip(rows, held):
        b = base(r[1])
        gone = sum(len(x.split(" ")) for x in h if count[r[3], x] > max_docs)
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        left = b[0] - gone
        out.append((r[0], *b, failed, not failed and left >= min_words and left >= min_left * b[0], gone))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_awkward_rows(awkward):
    assert got(quality_rules(awkward)) == brute(awkward_rows(), 50)


def test_frequent_lines_deplete(spark):
    common = "Accept all cookies to go on"
    rows = [(k, f"{common}\n{prose(k, 30)}\nACCEPT  all cookies to go on", "en", "a", 0) for k in range(20)]
    rows += [(100 + k, "\n".join([common] * 2 + [prose(7, 40)]), "en", "a" if k % 2 else None, 0) for k in range(20)]
    rows += [(200 + k, f"{prose(k, 25)} # $ <x>\n{common}", "en", "b", 0) for k in range(3)]
    out = got(quality_rules(frame(spark, rows), max_docs=9))
    assert out == brute(rows, 9)
    kept = {r[0]: r[7] for r in out}
    assert all(kept[k] for k in range(20)) and not any(kept[100 + k] for k in range(20)) and kept[200]


def test_empty_table(nothing):
    assert quality_rules(nothing).collect() == []
