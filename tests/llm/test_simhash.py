import random

import numpy as np
import pytest
import xxhash

from quayside.llm import simhash
from quayside.llm.components import components
from quayside.session import new_run_dir
from tests.llm.conftest import awkward_rows, frame, prose, words


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    shingles = [w[i : i + 3] for i in range(len(w) - 2)] or ([w] if w else [])
    hs = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def groups(prints, ids, most=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(prints))]


def expected(rows):
    prints = [fingerprint(r[1]) for r in rows]
    return sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, groups(prints, [r[0] for r in rows]))), key=str)


def near_copies():
    rng, rows = random.Random(5), []
    for k in range(12):
        base = prose(100 + k, rng.randrange(2, 400)).split()
        for c in range(rng.randrange(1, 5)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = "Changed"
            rows.append((1000 * c + k, " ".join(w), "en", "a", 0))
    return rows


@pytest.mark.parametrize("busy", [64, 0])
def test_documents_match_brute_force(spark, busy):
    rows = near_copies() + awkward_rows()
    out = simhash.simhash_groups(frame(spark, rows), busy=busy)
    assert sorted(map(tuple, out.collect()), key=str) == expected(rows)


def test_every_close_pair_meets_at_an_anchor():
    rng = np.random.default_rng(3)
    half = rng.integers(0, 2**32, 4000, dtype=np.uint64)
    other = half ^ (np.uint64(1) << rng.integers(0, 32, 4000, dtype=np.uint64))
    for x, y in ((half, other), (half, half)):
        ix, ax, lx = simhash.anchors(x)
        home = np.empty(len(x), np.uint64)
        home[ix[lx]] = ax[lx]
        assert lx.sum() == len(x) and (np.bitwise_count(home ^ x) <= 1).all()
        iy, ay, _ = simhash.anchors(y)
        visits = set(zip(iy.tolist(), ay.tolist()))
        assert all((k, int(h)) in visits for k, h in enumerate(home))
        assert np.bitwise_count(ay ^ y[iy]).max() <= 2 and len(visits) == len(iy) and len(iy) <= 17 * len(y)


@pytest.mark.parametrize("busy", [64, 2])
def test_clusters_of_fingerprints_match_brute_force(spark, busy):
    rng, prints = random.Random(9), []
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(40):
            x = c
            for b in rng.sample(range(64), rng.randrange(0, 6)):
                x ^= 1 << b
            prints.append(x)
    prints = sorted(set(prints))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long").repartition(3)
    run = new_run_dir(spark, "test")
    links = simhash.links(spark, df, run, busy=busy)
    root = {r["node"]: r["root"] for r in components(spark, links, f"{run}/c").collect()}
    mine = [root.get(signed(p), signed(p)) for p in prints]
    want = groups(prints, [signed(p) for p in prints])
    assert mine == want


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(900, 901), (901, 900)], "a long, b long")
    out = components(spark, df, new_run_dir(spark, "test")).collect()
    assert {(r["node"], r["root"]) for r in out} == {(k, 0) for k in range(201)} | {(900, 900), (901, 900)}
    assert len(out) == 203


def test_one_of_each_keeps_a_row_for_each_group(spark):
    rows = near_copies() + awkward_rows()
    df = frame(spark, rows)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    prints = [fingerprint(r[1]) for r in rows]
    want = [min((r[0] for r, q in zip(rows, g) if q == x and r[0] is not None), default=None) for g in [groups_of(prints)] for x in sorted(set(g))]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want, key=str)


def groups_of(prints):
    return groups(prints, list(range(len(prints))))


def test_empty_table(nothing):
    assert simhash.simhash_groups(nothing).collect() == [] and simhash.one_of_each(nothing).collect() == []
