import pytest
from pyspark.sql import functions as F

from quayside.functions.paths import landing_path, path_after, path_piece, size_mb, strip_extension

ROWS = [
    ("marker_missing", "s3://b/x/y.txt"),
    ("marker_once", "abfss://ws@h/id/Files/bucket/raw/a/b.txt"),
    ("marker_twice", "abfss://ws@h/id/Files/b/Files/raw/x/raw/y.txt"),
    ("marker_last", "abfss://ws@h/id/Files/"),
    ("upper", "abfss://ws@h/id/FILES/bucket/raw/c.tar.gz"),
    ("no_ext", "abfss://ws@h/Files/raw/dir/name"),
    ("null", None),
]


@pytest.fixture(scope="module")
def paths(spark):
    return spark.createDataFrame(ROWS, "case string, p string")


def _eval(paths, expr):
    return {r["case"]: r["v"] for r in paths.select("case", expr.alias("v")).collect()}


def test_bucket_path_after_first_marker(paths):
    got = _eval(paths, path_after("p", "/Files/"))
    assert got["marker_missing"] is None
    assert got["marker_once"] == "bucket/raw/a/b.txt"
    assert got["marker_twice"] == "b/Files/raw/x/raw/y.txt"
    assert got["marker_last"] == ""
    assert got["upper"] is None  # case-sensitive by default
    assert got["null"] is None


def test_bucket_path_ignore_case(paths):
    got = _eval(paths, path_after("p", "/files/", ignore_case=True))
    assert got["upper"] == "bucket/raw/c.tar.gz"
    assert got["marker_last"] == ""
    assert got["marker_missing"] is None
    assert got["marker_twice"] == "b/Files/raw/x/raw/y.txt"


def test_landing_piece_stops_at_second_marker(paths):
    got = _eval(paths, landing_path("p", "/raw/", "root"))
    assert got["marker_once"] == "root/a/b.txt"
    assert got["marker_twice"] == "root/x"  # the reference's second-piece rule
    assert got["marker_missing"] is None
    tail = _eval(paths, landing_path("p", "/raw/", "root", keep_tail=True))
    assert tail["marker_twice"] == "root/x/raw/y.txt"


def test_strip_extension_variants(paths):
    one = _eval(paths, landing_path("p", "/raw/", "r", strip_ext="txt"))
    assert one["marker_once"] == "r/a/b"
    assert one["upper"] == "r/c.tar.gz"
    anyx = _eval(paths, landing_path("p", "/raw/", "r", strip_ext="*"))
    assert anyx["upper"] == "r/c.tar"
    assert anyx["no_ext"] == "r/dir/name"


def test_markers_are_literal_not_regex(spark):
    df = spark.createDataFrame([("a/x.y/b",), ("a/xzy/b",)], "p string")
    got = [r[0] for r in df.select(path_after("p", "/x.y/")).collect()]
    assert got == ["b", None]
    got = [r[0] for r in df.select(path_piece("p", "/x.y/")).collect()]
    assert got == ["b", None]
    got = [r[0] for r in df.select(strip_extension(F.lit("a.b+c"), "b+c")).collect()]
    assert got == ["a", "a"]


def test_size_mb_rounding(spark):
    df = spark.createDataFrame([(10,), (6000,), (1048576,), (5242,), (0,)], "n long")
    got = [r[0] for r in df.select(size_mb("n")).collect()]
    assert got == [0.0, 0.01, 1.0, 0.0, 0.0]
    got = [r[0] for r in df.select(size_mb("n", 1024)).collect()]
    assert got == [0.01, 5.86, 1024.0, 5.12, 0.0]


def _py_after(s, m, ignore_case=False):
    if s is None:
        return None
    hay, needle = (s.lower(), m.lower()) if ignore_case else (s, m)
    i = hay.find(needle)
    return None if i < 0 else s[i + len(m):]


def _py_piece(s, m):
    if s is None or m not in s:
        return None
    return s.split(m)[1]


def _py_strip(s, ext):
    import re

    if s is None or ext is None:
        return s
    pat = r"\.\w+$" if ext == "*" else r"\." + re.escape(ext) + "$"
    return re.sub(pat, "", s, count=1, flags=re.ASCII)


def test_path_functions_match_python_model(spark):
    """Randomised paths (missing, repeated, trailing and mixed-case markers,
    extensions) evaluated in one Spark job against a plain-Python model."""
    import random

    rng = random.Random(7)
    parts = ["a", "b1", "raw", "RAW", "Files", "files", "x.tar", "y.gz", "z.txt", "q_1", "", "é"]
    rows = []
    for i in range(400):
        n = rng.randint(0, 7)
        path = "/".join(rng.choice(parts) for _ in range(n))
        if rng.random() < 0.3:
            path += rng.choice([".txt", ".csv", ".tar.gz", "/", ""])
        rows.append((i, rng.choice(["s3://b/", "file:/", ""]) + path))
    df = spark.createDataFrame(rows, "i int, p string")
    exprs = {
        "after": path_after("p", "/raw/"),
        "after_ci": path_after("p", "/files/", ignore_case=True),
        "piece": path_piece("p", "/raw/"),
        "land_txt": landing_path("p", "/raw/", "R", strip_ext="txt"),
        "land_any": landing_path("p", "/raw/", "R", keep_tail=True, strip_ext="*"),
    }
    got = {r["i"]: r for r in df.select("i", *[e.alias(k) for k, e in exprs.items()]).collect()}
    for i, p in rows:
        r = got[i]
        assert r["after"] == _py_after(p, "/raw/"), p
        assert r["after_ci"] == _py_after(p, "/files/", ignore_case=True), p
        assert r["piece"] == _py_piece(p, "/raw/"), p
        piece = _py_piece(p, "/raw/")
        assert r["land_txt"] == (None if piece is None else _py_strip("R/" + piece, "txt")), p
        tail = _py_after(p, "/raw/")
        assert r["land_any"] == (None if tail is None else _py_strip("R/" + tail, "*")), p
