"""Keyed tables in hash buckets: a merge rewrites the buckets its updates fall into and leaves every other file alone.

The key's hash names a partition of the table. An update is joined with those partitions only, which pruning keeps the
others out of, and written back over them. The work of a merge follows the buckets that are hit, not the table.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.cleaning import all_not_null
from tideline.operators.upsert import DuplicateKeys, ambiguous_matches, is_small, latest_per_key, row_changes, upsert
from tideline.sources.files import CORRUPT, VERSION
from tideline.sources.ingest import Feed, commit_marker, committed, delivered, first_version
from tideline.workspace import child_names, delete_folder

BUCKET = "_bucket"
CHANGE = "_change"


@dataclass(frozen=True)
class BucketedTable:
    """A parquet folder partitioned by the hash of its keys.

    Choose the number of buckets so that one is about a task's worth of rows; it cannot be changed later. Rows with a
    null key, and those a caller calls unkeyed, match nothing: each merge keeps its own in a partition of a negative
    number, the merge's, so that they are never rewritten and a repeated merge replaces just them.

    A merge writes new files first and moves whole partitions in at its end. One that dies between the moves leaves some
    buckets merged and some not, and is repeated under the same number: the same updates give the same table again.
    """

    path: str
    keys: Sequence[str]
    buckets: int = 64

    def _placed(self, df: DataFrame, number: int, keyed: Column) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.withColumn(BUCKET, F.when(keyed, bucket).otherwise(F.lit(-number)))

    def exists(self, spark: SparkSession) -> bool:
        return bool(child_names(spark, f"{self.path}/{BUCKET}=*"))

    def create(self, df: DataFrame, unkeyed: Column | None = None) -> None:
        """Writes the table from its first rows as they are, also where they repeat a key. Replaces what is there."""
        delete_folder(df.sparkSession, self.path)
        self._write(self._placed(df, 1, self._keyed(unkeyed)))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(BUCKET)

    def merge(
        self, updates: DataFrame, number: int, unkeyed: Column | None = None, newer_by: str | None = None
    ) -> list[int]:
        """Merges updates of unique keys and returns the buckets that were rewritten; `number` is 2 or more and names
        the merge.

        The updates are read several times, so give a table; they are cast to the table's types. Several rows of them that match one row are refused before
        anything is written. With newer_by a row is replaced only by one that is not older.
        """
        if number < 2:
            raise ValueError("merges are numbered from 2")
        hit, target, placed = self._sides(updates, number, unkeyed)
        keyed = placed.filter(F.col(BUCKET) >= 0)
        clash = ambiguous_matches(target, keyed, self.keys).limit(5).collect()
        if clash:
            raise DuplicateKeys(f"several updates match one row of {self.path}, for example {clash}")
        merged = upsert(target, keyed, self.keys, newer_by=newer_by, small_updates=is_small(keyed))
        self._write(merged.unionByName(placed.filter(F.col(BUCKET) < 0), allowMissingColumns=True))
        return hit

    def changes(self, updates: DataFrame, unkeyed: Column | None = None, newer_by: str | None = None) -> DataFrame:
        """The rows that a merge of these updates will take out and put in, with -1 and 1 in `_change`.

        Reads the buckets the updates fall into. To be asked for, and written, before the merge.
        """
        _, target, placed = self._sides(updates, 1, unkeyed)
        keyed, loose = placed.filter(F.col(BUCKET) >= 0), placed.filter(F.col(BUCKET) < 0)
        found = row_changes(target, keyed, self.keys, newer_by, is_small(keyed), CHANGE)
        return found.unionByName(loose.withColumn(CHANGE, F.lit(1)), allowMissingColumns=True).drop(BUCKET)

    def _sides(
        self, updates: DataFrame, number: int, unkeyed: Column | None
    ) -> tuple[list[int], DataFrame, DataFrame]:
        """The buckets hit, their rows, and the updates in the table's types with their buckets."""
        stored = updates.sparkSession.read.parquet(self.path)
        # In the table's types, which the files and the hashes of the keys are of.
        typed = {c: F.col(c).cast(stored.schema[c].dataType) for c in updates.columns if c in stored.columns}
        placed = self._placed(updates.withColumns(typed), number, self._keyed(unkeyed))
        hit = sorted(r[BUCKET] for r in placed.select(BUCKET).distinct().collect())
        return hit, stored.filter(F.col(BUCKET).isin([b for b in hit if b >= 0])), placed

    def _keyed(self, unkeyed: Column | None) -> Column:
        keyed = all_not_null(self.keys)
        return keyed if unkeyed is None else keyed & ~unkeyed

    def _write(self, placed: DataFrame) -> None:
        writer = placed.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(self.path)


def maintain_bronze(spark: SparkSession, feed: Feed, table: str, buckets: int = 64) -> DataFrame:
    """Brings the bucketed bronze up to the last committed delivery and returns it.

    Only deliveries committed since the last call are read, and only the buckets their keys fall into are rewritten. It
    holds the rows that `bronze` computes from the snapshot and the deliveries. The number of the last delivery merged
    is a marker file beside the buckets, created after the merge; a run that died before it is repeated. Once merged,
    a delivery's folder is not read again.

    Before a merge moves anything, the rows it takes out and puts in are written as a change set under its number, for
    what is maintained from bronze. A merge whose change set is complete is finished as it was begun, with the same
    deliveries, before later ones are taken.
    """
    kept = BucketedTable(f"{table}/bucketed/rows", feed.keys, buckets)
    done = max(committed(spark, table, "bucketed"), default=0)
    for begun in [n for n in committed(spark, table, "changes") if n > done]:
        _merge_since(spark, feed, table, kept, begun)
    _merge_since(spark, feed, table, kept)
    if not kept.exists(spark):
        return spark.createDataFrame([], feed.stored)
    return kept.read(spark).select(*feed.stored.names)


def _merge_since(spark: SparkSession, feed: Feed, table: str, kept: BucketedTable, upto: int | None = None) -> None:
    """Merges the deliveries committed since the last merge, at most those up to a number."""
    done = max(committed(spark, table, "bucketed"), default=0)
    since = [n for n in committed(spark, table, "deliveries") if n > done and (upto is None or n <= upto)]
    if not since:
        return
    tail, malformed = delivered(spark, feed, table, since), F.col(CORRUPT).isNotNull()
    if not done:
        first, begun = first_version(spark, table, since[0]), delivered(spark, feed, table, since[:1])
        kept.create(begun.filter(F.col(VERSION) == first), malformed)
        tail = begun.filter(F.col(VERSION) != first)
        tail = tail if len(since) == 1 else tail.unionByName(delivered(spark, feed, table, since[1:]))
    # Later versions of a key replace earlier ones first, so any number of deliveries is one merge.
    updates = latest_per_key(tail.filter(~malformed), feed.keys, [VERSION]).unionByName(tail.filter(malformed))
    if not tail.isEmpty():
        # A merge reads its updates several times.
        reduced = f"{table}/updates/commit={since[-1]}"
        updates.write.mode("overwrite").parquet(reduced)
        updates = spark.read.schema(feed.stored).parquet(reduced)
    changes, said = f"{table}/changes/commit={since[-1]}", since[-1] in committed(spark, table, "changes")
    if done and not said:
        kept.changes(updates, malformed, VERSION).write.mode("overwrite").parquet(changes)
        commit_marker(spark, changes)
    if not tail.isEmpty():
        kept.merge(updates, since[-1] + 1, malformed, newer_by=VERSION)
    if not done:
        # The table began here, so all of it has come.
        if kept.exists(spark):
            kept.read(spark).withColumn(CHANGE, F.lit(1)).write.mode("overwrite").parquet(changes)
        else:
            spark.createDataFrame([], feed.stored).withColumn(CHANGE, F.lit(1)).write.mode("overwrite").parquet(changes)
        commit_marker(spark, changes)
    commit_marker(spark, f"{table}/bucketed/commit={since[-1]}")
    delete_folder(spark, f"{table}/updates")
