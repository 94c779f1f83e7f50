"""Column names that an input of any columns does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> dict[str, str]:
    """For each name one like it that no column of ``df`` has, whatever their case."""
    have, out = {c.lower() for c in df.columns}, {}
    for name in names:
        new = f"_{name}"
        while new.lower() in have:
            new = f"_{new}"
        out[name] = new
        have.add(new.lower())
    return out
