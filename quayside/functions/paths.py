"""Column -> Column helpers that derive landing paths and sizes.

Markers are matched as literal text, never as regular expressions, so a path
separator or dot in a marker means itself. Every helper is a plain Catalyst
expression: it stays inside whole-stage codegen and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.schema import ANY_EXTENSION_PATTERN, BYTES_PER_MIB

ColumnOrName = "Column | str"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _java_quote(text: str) -> str:
    """Quote text for a Java regex so it matches literally."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def size_mb(length, factor: int = BYTES_PER_MIB) -> Column:
    """Bytes -> size in units of ``factor`` rounded half-up to 2 decimals."""
    return F.round(_c(length) / F.lit(factor), 2)


def path_after(col, marker: str, ignore_case: bool = False) -> Column:
    """Everything after the first occurrence of ``marker``.

    NULL when the marker does not occur, '' when nothing follows it.
    """
    c = _c(col)
    if ignore_case:
        pattern = "(?is)" + _java_quote(marker)
        return F.when(c.rlike(pattern), F.regexp_extract(c, pattern + "(.*)", 1))
    pos = F.instr(c, marker)
    return F.when(pos > 0, F.substr(c, pos + F.lit(len(marker))))


def path_piece(col, marker: str) -> Column:
    """The text between the first and the second occurrence of ``marker``
    (to the end when it occurs once); NULL when it does not occur."""
    c = _c(col)
    return F.when(F.instr(c, marker) > 0, F.split_part(c, F.lit(marker), F.lit(2)))


def strip_extension(col, ext: str | None) -> Column:
    """Drop a trailing extension: ``ext=None`` keeps the path, ``'*'`` drops any
    last ``.word`` suffix, otherwise only ``.ext`` is dropped."""
    c = _c(col)
    if ext is None:
        return c
    if ext == "*":
        return F.regexp_replace(c, ANY_EXTENSION_PATTERN, "")
    return F.regexp_replace(c, r"\." + _java_quote(ext.lstrip(".")) + "$", "")


def landing_path(
    col,
    marker: str,
    root: str,
    keep_tail: bool = False,
    strip_ext: str | None = None,
) -> Column:
    """``root + '/' + piece`` where piece follows ``marker`` in the source path.

    By default the piece ends at a second occurrence of the marker (the
    reference's behaviour); ``keep_tail=True`` keeps everything after the first.
    NULL when the marker is absent.
    """
    tail = path_after(col, marker) if keep_tail else path_piece(col, marker)
    return strip_extension(F.concat(F.lit(root + "/"), tail), strip_ext)
