"""Projections: aligning, conforming and ordering columns."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_to(df: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of `other`, in its order, taken from `df`."""
    return df.select(*other.columns)


def last(df: DataFrame, column: str) -> DataFrame:
    """The same columns with one moved to the end."""
    return df.select(*(c for c in df.columns if c != column), column)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns and types of `schema`; extra columns go, malformed text becomes null."""
    return df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields))


def without(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def predictions_as(df: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """The prediction column alone, named like the target it estimates."""
    return df.select(prediction).withColumnRenamed(prediction, target)


def overridden(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """`df` with some of its columns replaced, types and order kept."""
    return df.select(
        *(
            values[f.name].cast(f.dataType).alias(f.name) if f.name in values else F.col(f.name)
            for f in df.schema.fields
        )
    )
