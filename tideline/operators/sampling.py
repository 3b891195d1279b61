"""Samples and splits: Spark's own, and keyed ones that do not depend on partitioning."""

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.hashing import below, key_hash


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: str = "") -> DataFrame:
    """Keeps a row when its key hashes below the fraction: the same rows on every run and cluster."""
    return df.filter(below(key_hash(keys, seed), fraction))


def _bounds(weights: dict[str, float]) -> list[tuple[str, float, float]]:
    """(part, from, to) with the bounds scaled to end at 1."""
    ends = [round(end / sum(weights.values()), 12) for end in accumulate(weights.values())]
    return list(zip(weights, [0.0, *ends[:-1]], ends))


def with_split(
    df: DataFrame, keys: Sequence[str], weights: dict[str, float], seed: str = "", name: str = "split"
) -> DataFrame:
    """Labels each row with its part, e.g. {"train": .6, "validation": .2, "test": .2}, by key hash."""
    *firsts, (remainder, _, _) = _bounds(weights)
    label = F.lit(remainder)
    for part, _, end in reversed(firsts):
        label = F.when(below(F.col("_hash"), end), part).otherwise(label)
    return df.withColumn("_hash", key_hash(keys, seed)).withColumn(name, label).drop("_hash")


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: dict[str, float], seed: str = ""
) -> dict[str, DataFrame]:
    """The parts as separate frames; every row is in exactly one."""
    hashed = key_hash(keys, seed)
    return {part: df.filter(below(hashed, end) & ~below(hashed, start)) for part, start, end in _bounds(weights)}
