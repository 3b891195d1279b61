"""The composite score: a row-wise sum, as a native expression and as a SQL function."""

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def composite_score(columns: Sequence[str]) -> Column:
    """Sum of the columns as doubles, left to right; null when any part is null or not a number."""
    return reduce(add, (F.col(c).try_cast("double") for c in columns))


def corrected_score(composite: str, part: str) -> Column:
    """The composite without one of its parts, for models trained on fewer scores."""
    return F.col(composite).try_cast("double") - F.col(part).try_cast("double")


def register_composite_function(spark: SparkSession, name: str, arity: int) -> None:
    """Make the composite callable from SQL as name(s1, ..., s<arity>); it stays a native expression."""
    parts = [f"s{i}" for i in range(1, arity + 1)]
    parameters = ", ".join(f"{p} DOUBLE" for p in parts)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS DOUBLE RETURN {' + '.join(parts)}"
    )
