"""Bronze to silver: complete, non-blank, distinct rows."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.cleaning import columns_of_type, not_blank


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any null or NaN."""
    return df.dropna("any")


def drop_blank(df: DataFrame, trim: bool = False, exclude: Iterable[str] = ()) -> DataFrame:
    """Rows where no string column is blank."""
    return df.filter(not_blank(columns_of_type(df, T.StringType, exclude), trim))


def distinct_rows(df: DataFrame, lineage: Sequence[str] = ()) -> DataFrame:
    """Full-row deduplication. Copies that differ in the lineage columns alone are one row, the latest lineage wins.

    The first lineage column decides which is latest, the next ones ties: name the version before the path, since as
    text file 9 comes after file 10. Copies of one hot row collapse on the map side before the shuffle.
    """
    traced = [c for c in lineage if c in df.columns]
    if not traced:
        return df.dropDuplicates()
    content = [c for c in df.columns if c not in traced]
    newest = df.groupBy(*content).agg(F.max(F.struct(*traced)).alias("_newest"))
    return newest.select(*(F.col(f"_newest.{c}").alias(c) if c in traced else F.col(c) for c in df.columns))


def complete_rows(df: DataFrame, lineage: Sequence[str] = (), trim: bool = False) -> DataFrame:
    """Rows without a null, NaN or blank."""
    return drop_blank(drop_incomplete(df), trim, exclude=lineage)


def to_silver(df: DataFrame, lineage: Sequence[str] = (), trim: bool = False) -> DataFrame:
    """Filters first, so that only good rows are shuffled for the deduplication."""
    return distinct_rows(complete_rows(df, lineage, trim), lineage)
