"""A stored profile of a reference, so that a daily drift run reads the current rows and no row of the reference.

The profile is what the drift statistics need of a frame: how often each value of each column occurs, numbers in buckets
between stored bounds. Profiles of parts add up to the profile of the whole. The statistics are those of `drift`, equal
to what a run over both frames gives.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.drift import (
    DriftSettings,
    bucket_bounds,
    categorical_statistics,
    cell,
    comparable_columns,
    judged,
    numeric_statistics,
)


@dataclass(frozen=True)
class Profile:
    """A stored profile: the folder, and the numeric columns' bucket bounds and the categorical columns that it covers."""

    folder: str
    bounds: dict[str, list[float]]
    categorical: tuple[str, ...]

    @property
    def numeric(self) -> list[str]:
        return list(self.bounds)


def _occurrences(df: DataFrame, columns: Sequence[str], bounds: Sequence[Sequence[float]] | None) -> DataFrame:
    """(column, bucket, value) of every cell that is neither null nor NaN; without bounds as text in bucket 0.

    Text in a numeric column that is no number counts as missing.
    """
    kind = "double" if bounds is not None else "string"
    values = [f"v{i}" for i in range(len(columns))]
    found = df.selectExpr(*(f"{cell(c, kind)} AS {v}" for c, v in zip(columns, values, strict=True)))
    if bounds is not None:
        places = [f"bucket_of_{v}" for v in values]
        found = Bucketizer(
            splitsArray=[list(b) for b in bounds], inputCols=values, outputCols=places, handleInvalid="keep"
        ).transform(found)
    cells = (
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"bucket_of_{v}").cast("int") if bounds is not None else F.lit(0)).alias("bucket"),
            F.col(v).alias("value"),
        )
        for c, v in zip(columns, values, strict=True)
    )
    held = found.select(F.inline(F.array(*cells))).filter("value IS NOT NULL")
    return held.filter(~F.isnan("value")) if bounds is not None else held


def _counted(cells: DataFrame) -> DataFrame:
    return cells.groupBy("column", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))


_BOUNDS = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("place", T.IntegerType()),
    T.StructField("bounds", T.ArrayType(T.DoubleType())),
])


def write_profile(
    reference: DataFrame,
    folder: str,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    settings: DriftSettings = DriftSettings(),
) -> Profile:
    """Counts the reference, its columns of numbers and of categories or the given ones, into a new folder.

    The bounds of the buckets are stored too and stay those of the profile: they only lay out the work.
    """
    spark = reference.sparkSession
    numeric, categorical = comparable_columns(reference, reference, exclude)
    if columns is not None:
        numeric, categorical = ([c for c in kind if c in columns] for kind in (numeric, categorical))
    bounds = bucket_bounds(reference, numeric, settings) if numeric else []
    if numeric:
        _counted(_occurrences(reference, numeric, bounds)).write.mode("overwrite").parquet(f"{folder}/numeric")
    if categorical:
        _counted(_occurrences(reference, categorical, None)).write.mode("overwrite").parquet(f"{folder}/categorical")
    # Written last: a profile without it does not count.
    rows = [(c, i, list(b)) for i, (c, b) in enumerate(zip(numeric, bounds, strict=True))]
    rows += [(c, i, None) for i, c in enumerate(categorical)]
    spark.createDataFrame(rows, _BOUNDS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/columns")
    return read_profile(spark, folder)


def read_profile(spark: SparkSession, folder: str) -> Profile:
    """The profile in a folder; a row a column comes to the driver."""
    rows = sorted(spark.read.schema(_BOUNDS).parquet(f"{folder}/columns").collect(), key=lambda r: r["place"])
    bounds = {r["column"]: list(r["bounds"]) for r in rows if r["bounds"] is not None}
    return Profile(folder, bounds, tuple(r["column"] for r in rows if r["bounds"] is None))


def add_to_profile(profile: Profile, more: DataFrame, folder: str) -> Profile:
    """The profile of the reference and more rows of it, in a new folder; only the new rows are read."""
    spark = more.sparkSession
    for kind, names, bounds in _kinds(profile):
        added = _counted(_occurrences(more, names, bounds))
        both = spark.read.parquet(f"{profile.folder}/{kind}").unionByName(added)
        both.groupBy("column", "bucket", "value").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{folder}/{kind}")
    spark.read.schema(_BOUNDS).parquet(f"{profile.folder}/columns").coalesce(1).write.mode("overwrite").parquet(f"{folder}/columns")
    return read_profile(spark, folder)


def _kinds(profile: Profile) -> list[tuple[str, list[str], list[list[float]] | None]]:
    kinds: list[tuple[str, list[str], list[list[float]] | None]] = []
    if profile.bounds:
        kinds.append(("numeric", profile.numeric, list(profile.bounds.values())))
    if profile.categorical:
        kinds.append(("categorical", list(profile.categorical), None))
    return kinds


def statistics_against(
    profile: Profile,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    settings: DriftSettings = DriftSettings(),
) -> DataFrame:
    """All drift statistics of the columns that the profile and the current frame have, one row each.

    The counts of the profile and the cells of the current rows meet in one aggregate, which is written nowhere: one
    shuffle of distinct values.
    """
    spark = current.sparkSession
    parts = []
    for kind, names, bounds in _kinds(profile):
        shared = [c for c in names if c in current.columns and c not in exclude and (columns is None or c in columns)]
        if not shared:
            continue
        cells = _occurrences(current, shared, None if bounds is None else [profile.bounds[c] for c in shared])
        stored = spark.read.parquet(f"{profile.folder}/{kind}").filter(F.col("column").isin(shared))
        zero = F.lit(0).cast("long")
        place = F.create_map(*(x for i, c in enumerate(shared) for x in (F.lit(c), F.lit(i))))
        both = stored.select("column", "bucket", "value", F.col("n").alias("_r"), zero.alias("_c")).unionByName(
            cells.select("column", "bucket", "value", zero.alias("_r"), F.lit(1).cast("long").alias("_c"))
        )
        counts = both.groupBy(place[F.col("column")].alias("place"), "bucket", "value").agg(
            F.sum("_r").alias("r"), F.sum("_c").alias("c")
        )
        if bounds is None:
            parts.append(categorical_statistics(counts.drop("bucket"), shared))
        else:
            parts.append(numeric_statistics(counts, shared, settings))
    if not parts:
        raise ValueError("no comparable columns")
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def report_against(
    profile: Profile,
    current: DataFrame,
    run_date: str | None = None,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    settings: DriftSettings = DriftSettings(),
) -> DataFrame:
    """The verdict per column, as `drift.drift_report` gives it."""
    return judged(statistics_against(profile, current, columns, exclude, settings), run_date, settings)
