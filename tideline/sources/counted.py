"""Distinct rows with the number of their copies, in hash buckets: what a distinct needs so that rows can leave it.

A full-row distinct cannot be maintained from its result, since a copy that goes may or may not be the last one. With
the copies counted, a change is an addition, and only buckets with changed rows are rewritten.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources.buckets import BUCKET, CHANGE
from tideline.workspace import child_names, delete_folder

COMMIT = "commit"
COPIES = "_copies"
THROUGH = "_through"


def replace_buckets(df: DataFrame, path: str, hit: Sequence[int], filled: DataFrame) -> None:
    """Replaces the buckets `hit` of a folder by the rows of `df`; a bucket that no row of `filled` lies in goes.

    `filled` has rows in the same buckets as `df` and is cheap to read. Other buckets' files stay as they are.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(path)
    for bucket in set(hit) - {r[BUCKET] for r in filled.select(BUCKET).distinct().collect()}:
        delete_folder(df.sparkSession, f"{path}/{BUCKET}={bucket}")


@dataclass(frozen=True)
class CountedRows:
    """A parquet folder of distinct rows and their copies, partitioned by the hash of the content columns.

    Rows may hold more columns than the content, such as lineage; rows of one content share a bucket. Content without
    nulls is assumed. Each bucket tells through which change set it is counted, so a run that died between the moves
    of its partitions is repeated without counting twice. A row whose copies are gone stays with none until its bucket
    changes next, so no bucket loses that mark with its last row.
    """

    path: str
    content: Sequence[str]
    buckets: int = 64

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.content), F.lit(self.buckets)).cast("int"))

    def hit(self, changes: DataFrame) -> list[int]:
        """Buckets with changed rows, at most `buckets` numbers."""
        return sorted(r[BUCKET] for r in self.placed(changes).select(BUCKET).distinct().collect())

    def exists(self, spark: SparkSession) -> bool:
        return bool(child_names(spark, f"{self.path}/{BUCKET}=*"))

    def apply(self, changes: DataFrame, number: int) -> list[int]:
        """Adds change sets, rows with `_change` and the `commit` they belong to, up to `number`; returns the buckets hit.

        Change sets that a bucket has counted are passed over.
        """
        hit = self.hit(changes)
        if not hit:
            return []
        spark, placed = changes.sparkSession, self.placed(changes)
        stored = None
        if self.exists(spark):
            stored = spark.read.parquet(self.path).filter(F.col(BUCKET).isin(hit))
            # One row a bucket.
            through = F.broadcast(stored.groupBy(BUCKET).agg(F.max(THROUGH).alias(THROUGH)))
            known = placed.join(through, BUCKET, "left")
            placed = known.filter(F.col(COMMIT) > F.coalesce(THROUGH, F.lit(0))).drop(THROUGH)
        rows = [c for c in placed.columns if c not in (CHANGE, COMMIT, BUCKET)]
        # Copies of a hot row are added up before the shuffle, which then brings each bucket together once.
        counted = placed.groupBy(BUCKET, *rows).agg(F.sum(CHANGE).alias(COPIES))
        if stored is not None:
            counted = stored.filter(F.col(COPIES) != 0).select(counted.columns).unionByName(counted)
        total = counted.repartition(BUCKET).groupBy(BUCKET, *rows).agg(F.sum(COPIES).alias(COPIES))
        writer = total.withColumn(THROUGH, F.lit(number).cast("long")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        return hit

    def present(self, spark: SparkSession, hit: Sequence[int]) -> DataFrame:
        """Rows of some buckets that have copies, with their bucket."""
        stored = spark.read.parquet(self.path).filter(F.col(BUCKET).isin(list(hit)) & (F.col(COPIES) > 0))
        return stored.drop(COPIES, THROUGH)
