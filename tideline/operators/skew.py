"""Test data for monitors: skewed numeric columns and rows with defects."""

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.cleaning import columns_of_type, nullify
from tideline.functions.hashing import hash_normal
from tideline.operators.columns import overridden
from tideline.operators.drift import numeric_quantiles

# Normal quantiles at -3z, -z, z, 3z for z = 0.524 (Slifker and Shapiro 1980).
_Z = 0.524
_LEVELS = [0.5 * math.erfc(-k * _Z / math.sqrt(2)) for k in (-3, -1, 1, 3)]


def fit_johnson_su(quantiles: Sequence[float]) -> tuple[float, float, float, float] | None:
    """(gamma, delta, xi, lambda) from the four quantiles, or None where the shape is not unbounded."""
    low3, low1, high1, high3 = quantiles
    p, m, n = high1 - low1, high3 - high1, low1 - low3
    if p <= 0 or m <= 0 or n <= 0 or m * n / p**2 <= 1.0:
        return None
    mp, np_ = m / p, n / p
    delta = 2 * _Z / math.acosh((mp + np_) / 2)
    gamma = delta * math.asinh((np_ - mp) / (2 * math.sqrt(mp * np_ - 1)))
    scale = 2 * p * math.sqrt(mp * np_ - 1) / ((mp + np_ - 2) * math.sqrt(mp + np_ + 2))
    xi = (high1 + low1) / 2 + p * (np_ - mp) / (2 * (mp + np_ - 2))
    return gamma, delta, xi, scale


def _draw(fit: Row, keys: Sequence[str], seed: str) -> Column:
    z = hash_normal(keys, f"{seed}/{fit.column}")
    johnson = fit_johnson_su(fit.quantiles)
    if johnson is None:
        return F.lit(fit.mean) + F.lit(fit.sd) * z
    gamma, delta, xi, scale = johnson
    return xi + scale * F.sinh((z - gamma) / delta)


def skew_numeric(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, seed: str = "42"
) -> DataFrame:
    """Replaces double columns by draws from a Johnson SU distribution fitted to each.

    Four exact quantiles, mean and deviation of every column come from counts over all rows; the draws come from the
    row's key, so a recomputed task repeats them. Columns whose quantiles do not fit the family are drawn from a
    normal; a column without a value stays as it is.
    """
    columns = list(columns or columns_of_type(df, T.DoubleType, exclude=keys))
    fits = numeric_quantiles(df, columns, _LEVELS).collect()
    return df.withColumns({f.column: F.when(F.col(f.column).isNotNull(), _draw(f, keys, seed)) for f in fits})


def append_variants(df: DataFrame, variants: Iterable[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """`df` followed by copies of given rows with some columns overridden, e.g. by unknown categories."""
    for rows, values in variants:
        df = df.unionByName(overridden(rows, values))
    return df


def blank_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: nullify(c) for c in columns})
