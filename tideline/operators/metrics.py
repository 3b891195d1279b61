"""Model quality and inspection aggregates."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rmse(df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error, over all rows or per group such as the split (map-side combined)."""
    squared = F.pow(F.col(prediction) - F.col(label), 2.0)
    return df.groupBy(*by).agg(F.sqrt(F.avg(squared)).alias("rmse"))


def target_profile(df: DataFrame, predictor: str, target: str) -> DataFrame:
    """Count, mean and range of the target per predictor value."""
    return df.groupBy(predictor).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(target).alias("avg_target"),
        F.min(target).alias("min_target"),
        F.max(target).alias("max_target"),
    )
