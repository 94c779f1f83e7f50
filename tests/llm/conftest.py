import random

import pytest

WORDS = "alpha beta gamma delta omega sigma kappa theta lambda zeta eta iota mu nu xi rho tau phi chi psi".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, odd white space and characters."""
    long = prose(1, 30_000)
    return [
        (1, prose(2, 60), "en", "a", 10), (2, prose(2, 60), "en", "a", 10), (2, prose(2, 60), "en", "a", 10),
        (3, None, "en", "b", 0), (4, "", None, "b", 0), (5, " \t\n\x0b\f\r ", "de", None, None),
        (None, prose(3, 40), "en", "c", 5), (None, None, None, None, None), (None, prose(3, 40), "en", "c", 5),
        (6, long, "en", "a", len(long)), (7, long + " end", "en", "b", None), (8, "one", "en", "a", 3),
        (9, "café  nbsp em \U0001f600 İstanbul <|endoftext|> it's 3.14 it''s", "fr", "é", 30),
        (10, "x " * 500, "en", "\U0001f600", 1000), (11, "\n\n".join([prose(4, 12)] * 9), "en", "a", 1),
        (12, prose(5, 300), "en", "", 9), (13, prose(5, 150) + " " + prose(6, 150), "en", "a", 9),
    ]


EXTRA = ["size", "score", "hash", "fp", "block", "row", "key", "t", "at", "_source", "root", "label", "component_id", "taken", "host", "tie"]


def frame(spark, rows, parts=3):
    """``documents`` rows with further columns whose names operators use themselves."""
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(*r, *[f"x{k}" for k in range(len(EXTRA))]) for r in rows], ddl).repartition(parts)


@pytest.fixture(scope="session")
def awkward(spark):
    return frame(spark, awkward_rows())


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [], 1)


@pytest.fixture(scope="session")
def label_rows(spark):
    rows = [(k, k % 2, int(k % 3 == 0)) for k in range(1, 14)] + [(None, 1, 1), (5, None, None), (5, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def words(text):
    """``[^\\x20\\x09-\\x0D]+`` of a text."""
    import re

    return re.findall("[^\\x20\\x09-\\x0D]+", text or "")
