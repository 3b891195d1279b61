"""Delivery versions, read from file names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A delivery is a file <name>_<n>.csv, compressed or not, or a folder of that name holding part files.
VERSION_PATTERN = r"_([0-9]+)\.csv(?:\.[a-z0-9]+)?(?:/|$)"


def file_version(path: str | Column, pattern: str = VERSION_PATTERN) -> Column:
    """The version number in a path; null where the path carries none or one beyond 64 bits."""
    return F.regexp_extract(path, pattern, 1).try_cast("bigint")
