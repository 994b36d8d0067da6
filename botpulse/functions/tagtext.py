"""String helpers for tag names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from botpulse.functions.constants import PATH_LUNA, PATH_V5, TAG_SEPARATOR, V5_PREFIX_PATTERN


def is_v5_path(path: Column) -> Column:
    """``path LIKE '%V5%'`` (case-sensitive substring)."""
    return path.contains(PATH_V5)


def is_luna_path(path: Column) -> Column:
    """``path LIKE '%Luna%'`` (case-sensitive substring)."""
    return path.contains(PATH_LUNA)


def strip_v5_prefix(name: Column) -> Column:
    """``TRIM(REGEXP_REPLACE(name, '^V5\\s+', ''))``: leading "V5" plus blanks removed."""
    return F.trim(F.regexp_replace(name, V5_PREFIX_PATTERN, ""))


def pieces(joined: Column) -> Column:
    """The comma-separated pieces of ``joined`` (empty pieces kept)."""
    return F.split(joined, TAG_SEPARATOR, -1)
