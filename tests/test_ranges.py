"""Flat folders split by ranges of names, and many roots as one frontier."""

import bisect
import random

import pandas as pd
import pytest

from quayside.sources import listing
from quayside.sources.files import scan_files
from tests.conftest import write_file


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def names_of(n, seed=0):
    rng = random.Random(seed)
    kinds = [lambda: f"part-{rng.randrange(10**6):06d}.parquet", lambda: f"{rng.getrandbits(64):016x}", lambda: f"é{rng.randrange(10**5)}", lambda: "Z" * rng.randrange(1, 9)]
    return sorted({rng.choice(kinds)() for _ in range(n)})


def keys(names, limit=None):
    """A store that lists names in order, in pages; the number of names handed out by each call."""
    calls = []

    def pages(parent, after, until):
        at = bisect.bisect_right(names, after) if after is not None else 0
        calls.append(0)
        mine = len(calls) - 1
        for name in names[at:]:
            if until is not None and name > until:
                return
            calls[mine] += 1
            yield name, False, 7, 1_600_000_000_000

    return pages, calls


def rounds(lister, folder):
    """All file names that rounds of one task list, and the number of rounds."""
    todo, files, n = pd.DataFrame({"dir": [folder], "after": [None], "until": [None]}, dtype=object), [], 0
    while len(todo):
        out = pd.concat([*lister(iter([todo])), pd.DataFrame(columns=["kind", "path", "after", "until"])])
        files += out[out.kind == "file"].path.tolist()
        todo, n = out[out.kind == "dir"].rename(columns={"path": "dir"})[["dir", "after", "until"]], n + 1
    return files, n


@pytest.mark.parametrize("seed,limit", [(0, 50), (1, 7), (2, 1), (3, 4000), (4, 300)])
def test_ordered_keys_are_listed_once_in_bounded_pages(seed, limit):
    names = names_of(3_000, seed)
    pages, calls = keys(names)
    files, n = rounds(listing._lister(None, 10**9, page_limit=limit, pages=pages, threads=1), "s3://bucket/flat")
    assert sorted(files) == [f"s3://bucket/flat/{x}" for x in names]
    assert max(calls) <= limit + 1


def test_a_million_keys_fan_out(spark, tmp_path):
    def pages(parent, after, until):
        k = 0 if after is None else bisect.bisect_right(range(10**6), after, key=lambda x: f"part-{x:07d}")
        while k < 10**6 and (until is None or f"part-{k:07d}" <= until):
            yield f"part-{k:07d}", False, 5, 0
            k += 1

    seen = spark.sparkContext.accumulator(0)
    out = listing.list_files(spark, "s3://bucket/flat", f"{tmp_path}/staging", dir_counter=seen, pages=pages)
    row = out.selectExpr("count(*) n", "count(distinct path) d").first()
    assert (row["n"], row["d"]) == (10**6, 10**6)
    assert seen.value >= 50  # no listing of more than PAGE_LIMIT keys


@pytest.mark.parametrize("limit", [1, 10, 400, 5_000])
def test_local_folder_by_ranges(spark, tmp_path, limit):
    names = names_of(1_200, limit) + ["_hidden", ".dot", "a=b", "sub space"]
    for k, x in enumerate(names):
        write_file(f"{tmp_path}/src/{x}.txt", b"1" * (k % 3))
    write_file(f"{tmp_path}/src/deeper/x/y.txt", b"2")
    assert same(listing.list_files(spark, f"{tmp_path}/src", page_limit=limit), scan_files(spark, f"{tmp_path}/src"))


def test_no_local_task_stats_a_flat_folder_alone(tmp_path):
    folder = tmp_path / "flat"
    folder.mkdir()
    for k in range(9_000):
        (folder / f"f{k:05d}").write_bytes(b"1")
    lister = listing._lister(None, 10**9, page_limit=1_000, fanout=64)
    first = pd.concat(lister(iter([pd.DataFrame({"dir": [f"file:{folder}"]})])))
    assert set(first.kind) == {"dir"} and len(first) == 18
    sizes = []
    for row in first.itertuples():
        sizes.append(sum(map(len, lister(iter([pd.DataFrame({"dir": [row.path], "after": [row.after], "until": [row.until]})])))))
    assert sum(sizes) == 9_000 and max(sizes) <= 1_000


def test_jobs_depend_on_depth_not_on_matches(spark, tmp_path):
    for k in range(12):
        write_file(f"{tmp_path}/src/p{k:02d}/a/b/f{k}.txt", b"1")
    write_file(f"{tmp_path}/src/p99", b"a file among the matches")

    def jobs(root, label):
        tracker, group = spark.sparkContext.statusTracker(), f"roots-{label}"
        spark.sparkContext.setJobGroup(group, group)
        found = listing.list_files(spark, root, f"{tmp_path}/staging-{label}")
        n = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, n

    one, n_one = jobs(f"{tmp_path}/src/p00", "one")
    many, n_many = jobs(f"{tmp_path}/src/p*", "many")
    roots, n_roots = jobs([f"{tmp_path}/src/p01", f"{tmp_path}/src/p0[2-4]"], "list")
    assert n_one == n_many == n_roots
    assert one.count() == 1 and roots.count() == 4
    assert same(many, scan_files(spark, f"{tmp_path}/src/p*"))
