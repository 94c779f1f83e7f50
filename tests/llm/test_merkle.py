import hashlib
import zlib

import pytest

from quayside.llm import merkle
from quayside.session import new_run_dir
from tests.llm.conftest import awkward_rows, frame, prose

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """Root of the nodes, and the siblings (left, right) that each meets on its way."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            a = i // 8 * 8
            steps[k].append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 8])))
        nodes, at = [H(*nodes[a : a + 8]) for a in range(0, len(nodes), 8)], [i // 8 for i in at]
    return nodes[0], steps


def brute(rows):
    leaves = []
    for doc_id, text, lang, source, n_chars in rows:
        head = "".join(map(field, (doc_id, source, lang, n_chars)))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        leaf = H(head, field(text))
        leaves.append((doc_id, lang, leaf, H(head, field(lower(text))) if hit else leaf))
    trees = []
    for lang in sorted({x[1] for x in leaves}, key=lambda v: (v is not None, (v or "").encode())):
        of = sorted((x for x in leaves if x[1] == lang), key=lambda x: (x[0] is not None, x[0] or 0, x[2]))
        trees.append((of, *climb([x[2] for x in of])))
    if not trees:
        return []
    root, upper = climb([t[1] for t in trees])
    out = []
    for (of, subroot, steps), more in zip(trees, upper):
        for (doc_id, _, leaf, tampered), own in zip(of, steps):
            for left, right in own + more:
                tampered = H(left, tampered, right)
            out.append((doc_id, leaf, subroot, root, H(*[s for step in own + more for s in step]), tampered, tampered == root))
    return out


def check(spark, rows, parts=3):
    out = merkle.verify(frame(spark, rows, parts), new_run_dir(spark, "merkle"))
    assert out.columns == COLUMNS
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, brute(rows)))


def many(n, langs, seed=0):
    return [(k, prose(seed + k, 2 + k % 5).title(), langs[(k * k + k) % len(langs)], "a", k) for k in range(n)]


CASES = {
    "awkward": awkward_rows(),
    "a third in one lang, six levels of blocks": many(1300, ["en", "en", None, "de", "é", "Z"]) + [(9999, "X y", "solo", "a", 1)],
    "one lang": many(600, ["en"]),
    "one run and one more": many(9, ["en"]),
    "repeated rows": [(5, "Same Text", "en", "a", 9)] * 70 + [(None, "Same", "en", "a", None)] * 9,
    "lone leaf": [(0, "A", None, None, None)],
    "lone leaves of many langs": [(k, f"T {k}", f"l{k:03d}", "s", 1) for k in range(75)],
}


@pytest.mark.parametrize("name", CASES)
def test_brute_force(spark, name):
    # the row limit of recursive queries must not hold here
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "5")
    try:
        check(spark, CASES[name])
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)


def test_tampering_shows(spark):
    rows = [(k, "Text With Capitals", "en", "a", 1) for k in range(100)] + [(k, "plain", "de", "a", 1) for k in range(100, 200)]
    got = {r["doc_id"]: r["verified"] for r in merkle.verify(frame(spark, rows)).collect()}
    assert got == {k: k >= 100 or zlib.crc32(str(k).encode()) % 3 != 0 for k in range(200)}


def test_empty_table(nothing):
    out = merkle.verify(nothing)
    assert out.columns == COLUMNS and out.collect() == []
