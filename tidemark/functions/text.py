"""String, path and JSON-text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: file names carry the entity before the century of their time stamp.
ENTITY_MARK = "_20"


def before_mark(text: Column, mark: str = ENTITY_MARK) -> Column:
    """Text before the first `mark`; the empty string when the mark is absent."""
    position = F.regexp_instr(text, F.lit(mark))
    return F.substring(text, F.lit(1), position - 1)


def entity_of(file_name: Column) -> Column:
    """Entity a file feeds: the name up to the time stamp."""
    return before_mark(file_name)


def file_stamp(file_name: Column) -> Column:
    """Time stamp in `<entity>_<yyyymmdd>_<hhmiss>.<ext>`, NULL when there is none."""
    digits = F.regexp_extract(file_name, r"_(20\d{6}_\d{6})", 1)
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def absolute_path(folder: str, relative: Column) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), relative)


def plain_path(path: Column) -> Column:
    """Path without a `file:` scheme and its run of slashes."""
    return F.regexp_replace(path, r"^file:/+", "/")


def relative_path(folder: str, path: Column) -> Column:
    """Path below `folder`; the input unchanged when it lies elsewhere."""
    base = folder.rstrip("/") + "/"
    plain = plain_path(path)
    return F.when(plain.startswith(base), F.substring(plain, F.lit(len(base) + 1), F.length(plain))).otherwise(plain)


def stage_location(folder: str) -> Column:
    return F.lit(folder.rstrip("/") + "/")


def joined(*parts: Column | str, sep: str = "") -> Column:
    """Concatenation that is NULL as soon as one part is NULL."""
    columns = []
    for i, part in enumerate(parts):
        if i and sep:
            columns.append(F.lit(sep))
        columns.append(part if isinstance(part, Column) else F.lit(part))
    return F.concat(*columns)
