import hashlib
import re

from pyspark.sql import functions as F

from quayside.llm import fill_in_middle as fim
from tests.llm.conftest import awkward_rows, frame, prose


def brute(doc_id, text, fim_percent=100, spm_percent=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_percent:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def lined(seed, lines):
    return "".join(prose(seed + k, 1 + k % 7) + "\n" for k in range(lines))


ROWS = awkward_rows() + [
    (100 + k, t, "en", "a", 0)
    for k, t in enumerate(
        ["\n", "\n\n\n", "a\n\n", "\n\nb", "x\ry\r\nz", "no end", "é\n\U0001f600\U0001f600\n日本", "\u2028a\u2029b\x85c\nd", "a <P> b\nc\n", "<S>\n", "q<M>q", "<p>\n<s>\n", "<P\n>",
         "a<\nP>b\nS>\n", "<\n<\n<\n", "$1 \\1\n$2\n\\\n", lined(3, 20_000), "\n" * 30_000, "y" * 400_000, "a\x00b\nc"]
    )
]


def test_brute_force(spark):
    out = fim.transform(frame(spark, ROWS))
    got = out.select(
        "doc_id", "n", "form", F.char_length("prefix"), F.char_length("middle"), "output", fim.restored(F.col("output"), F.col("form"))
    ).collect()
    want = [brute(r[0], r[1]) for r in ROWS]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_shares(spark):
    rows = [(k, prose(k, 5) + "\n" + prose(k, 4), "en", "a", 0) for k in range(200)]
    got = fim.transform(frame(spark, rows), fim_percent=60, spm_percent=20).select("doc_id", "form").collect()
    assert {r[0]: r[1] for r in got} == {r[0]: brute(r[0], r[1], 60, 20)[2] for r in rows}


def test_no_shuffle_no_python(spark, awkward, capsys):
    fim.transform(awkward).explain("formatted")
    plan = capsys.readouterr().out.split("Scan ExistingRDD")[0]
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(nothing):
    assert fim.transform(nothing).collect() == []
