"""Silver to gold: the composite score."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tideline.functions.scoring import composite_score, corrected_score
from tideline.operators.columns import last


def to_gold(df: DataFrame, scores: Sequence[str], name: str, target: str | None = None) -> DataFrame:
    """`df` with the sum of `scores`; with a target given, that column comes last."""
    scored = df.withColumn(name, composite_score(scores))
    return last(scored, target) if target else scored


def correct_score(df: DataFrame, name: str, part: str) -> DataFrame:
    """Takes one part back out of the composite; a frame without the composite is returned as it is."""
    return df.withColumn(name, corrected_score(name, part)) if name in df.columns else df
