"""Key columns: composite keys, keys parsed from file names, row ids, box arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern of patch file names, <slide>_<digits>-<x>-<y>.
PATCH_KEY_PATTERN = r"(\w+)_(\d+)-(\d+)-(\d+)"


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def build_key(*parts: str | Column, sep: str = "-", strict: bool = False) -> Column:
    """Join the parts into one text key.

    Null parts are skipped, as ``concat_ws`` does, so all-null parts give ``''``.
    With ``strict`` a null part makes the whole key null; such a row then never
    matches in a join.
    """
    columns = [_column(part) for part in parts]
    key = F.concat_ws(sep, *columns)
    if not strict:
        return key
    complete = reduce(lambda a, b: a & b, [column.isNotNull() for column in columns])
    return F.when(complete, key)


def file_name(path: str | Column) -> Column:
    """The last component of a slash-separated path."""
    return F.substring_index(_column(path), "/", -1)


def parse_key(
    path: str | Column,
    pattern: str = PATCH_KEY_PATTERN,
    file_name_only: bool = True,
    empty_as_null: bool = True,
) -> Column:
    """The whole text matched by ``pattern``.

    The match is looked for in the file name, so a directory that looks like a
    key cannot win; ``file_name_only=False`` takes the leftmost match in the
    full path. No match gives null, or ``''`` with ``empty_as_null=False``.
    """
    text = file_name(path) if file_name_only else _column(path)
    key = F.regexp_extract(text, pattern, 0)
    return F.nullif(key, F.lit("")) if empty_as_null else key


def row_id(*parts: str | Column, random: bool = False) -> Column:
    """A row id: a SHA-256 of the key parts, or a random UUID.

    The hash is the same on every run, which makes an upsert by this id
    idempotent; the UUID is not, and also blocks predicate pushdown.
    """
    if random:
        return F.expr("uuid()")
    return F.sha2(build_key(*parts), 256)


def box_origin(center: str | Column, size: int, downsample: int = 1) -> Column:
    """First coordinate of a box of ``size`` level pixels around a level-0 centre."""
    return _column(center).cast("int") - F.lit(size // 2 * downsample)


def patch_name(sid: str | Column, x: str | Column, y: str | Column) -> Column:
    """``<sid>-<x>-<y>``, null when a part is null."""
    return build_key(sid, x, y, strict=True)


def patch_path(folder: str | Column, name: Column, suffix: str) -> Column:
    """``<folder>/<name>.<suffix>``."""
    base = F.lit(folder) if isinstance(folder, str) else folder
    return F.concat(base, F.lit("/"), name, F.lit(f".{suffix}"))
