"""Incremental ingest of versioned deliveries into a bronze table.

Landing appends: each run writes its deliveries, and nothing else, to a new folder of the table, so its cost
follows the delivery and not the table. The bronze frame is the last snapshot with later deliveries merged in;
compacting writes it as the next snapshot.

Commits are numbered in one sequence per table, whoever writes them: a batch run, a stream, or a snapshot, which
carries the number of the last delivery in it. The ledger names the files of every commit, so a file is pending if the
ledger does not name it. Deliveries may come late or out of order, in batch or as a stream, also after a snapshot and
under a new stream checkpoint: each is taken once, and a key keeps the row of its greatest version.

A folder counts once its marker file exists, which is created after the write and its checks; a run that died before
that leaves nothing visible and is simply repeated under the same number. One writer at a time is assumed.
"""

import hashlib
import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.versions import VERSION_PATTERN
from tideline.operators.expectations import Rule, check_observed, observed
from tideline.operators.upsert import DuplicateKeys, duplicate_keys, is_small, latest_per_key, upsert
from tideline.schemas import LINEAGE
from tideline.sources.files import CORRUPT, VERSION, files_present, scan_csv, with_corrupt, with_lineage
from tideline.workspace import child_names, delete_folder

_MARKER = "_COMMITTED"
_LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("batch", T.StringType()),
    T.StructField("commit", T.LongType()),
])


@dataclass(frozen=True)
class Feed:
    """A landing area and how its files update the table.

    on_duplicate says what to do when one delivery repeats a key: "error" refuses the delivery (the very first is
    taken as it is, since it merges into nothing), "latest" keeps the row with the greatest order_by values.
    Malformed lines are no updates: they are stored and counted, and neither replace a row nor repeat a key.
    on_unnamed says what to do with a file whose name carries no version: "error" stops the run, "skip" leaves the file.
    rules are counted by the write of a delivery; a violated 'fail' rule refuses the delivery as a whole. A batch run then
    raises; a stream goes on with the next micro-batch and notes the refusal (see `refusals`).
    """

    source: str
    schema: T.StructType
    keys: Sequence[str]
    pattern: str = VERSION_PATTERN
    on_duplicate: str = "error"
    order_by: Sequence[str] = field(default_factory=tuple)
    on_unnamed: str = "error"
    rules: Sequence[Rule] = field(default_factory=tuple)

    @property
    def stored(self) -> T.StructType:
        lineage = [T.StructField(LINEAGE, T.StringType()), T.StructField(VERSION, T.LongType())]
        return T.StructType([*with_corrupt(self.schema).fields, *lineage])


def table_folder(root: str, name: str, test_mode: bool = False) -> str:
    """Test runs live beside the real table under a prefix."""
    return f"{root.rstrip('/')}/{'test_' if test_mode else ''}{name}"


def committed(spark: SparkSession, table: str, kind: str) -> list[int]:
    """Numbers of the committed folders of a kind, such as "deliveries" or "snapshots", ascending."""
    marks = child_names(spark, f"{table}/{kind}/commit=*/{_MARKER}")
    return sorted(int(re.search(r"commit=(\d+)/", mark).group(1)) for mark in marks)


def commit_marker(spark: SparkSession, folder: str) -> None:
    """Makes a folder count."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{_MARKER}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def _last_commit(spark: SparkSession, table: str) -> int:
    """Number of the last commit, 0 before the first."""
    return max([0, *committed(spark, table, "deliveries"), *committed(spark, table, "snapshots")])


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """(path, version, batch, commit) of every file taken; batch names the micro-batch that a stream took it in."""
    last = _last_commit(spark, table)
    if not last:
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{table}/ledger").filter(F.col("commit") <= last)


def last_version(spark: SparkSession, table: str) -> int | None:
    """The high-water mark: the greatest version committed so far, as a number."""
    return ledger(spark, table).agg(F.max("version").alias("v")).first().v


def store_delivery(
    feed: Feed, rows: DataFrame, table: str, files: DataFrame | None = None, batch: str | None = None
) -> None:
    """Writes one batch of deliveries as the next commit. `files` are its (path, version); by default those of the rows."""
    spark = rows.sparkSession
    last = _last_commit(spark, table)
    folder = f"{table}/deliveries/commit={last + 1}"
    per_delivery = [*feed.keys, VERSION]
    if feed.on_duplicate == "latest":
        formed = F.col(CORRUPT).isNull()
        rows = latest_per_key(rows.filter(formed), per_delivery, feed.order_by).unionByName(rows.filter(~formed))
    rows, rule_list = rows.select(*feed.stored.names), list(feed.rules)
    rows, observation = observed(rows, rule_list) if rule_list else (rows, None)
    rows.write.mode("overwrite").partitionBy(VERSION).parquet(folder)
    if observation:
        check_observed(observation, rule_list)
    stored = spark.read.schema(feed.stored).parquet(folder)
    if feed.on_duplicate == "error":
        keyed = stored.filter(F.col(CORRUPT).isNull())
        if not last:
            keyed = keyed.filter(F.col(VERSION) > min(_versions_in(spark, folder), default=0))
        repeated = duplicate_keys(keyed, per_delivery).limit(5).collect()
        if repeated:
            raise DuplicateKeys(f"deliveries repeat keys, for example {repeated}")
    if files is None:
        files = stored.select(F.col(LINEAGE).alias("path"), F.col(VERSION).alias("version")).distinct()
    files.withColumn("batch", F.lit(batch).cast("string")).write.mode("overwrite").parquet(f"{table}/ledger/commit={last + 1}")
    commit_marker(spark, folder)


def refuse(files: DataFrame, violations: Mapping[str, int], table: str, batch: str) -> None:
    """Notes that the files of a micro-batch were refused. They stay pending."""
    noted = files.withColumn("violations", F.from_json(F.lit(json.dumps(violations)), "map<string,long>"))
    folder = hashlib.sha1(batch.encode()).hexdigest()
    noted.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{table}/refused/{folder}")


def refusals(spark: SparkSession, table: str) -> DataFrame:
    """(path, version, violations, batch) of the files that streams refused; violations are per 'fail' rule and batch."""
    kept = T.StructType([*_LEDGER.fields[:2], T.StructField("violations", T.MapType(T.StringType(), T.LongType())), _LEDGER["batch"]])
    folders = child_names(spark, f"{table}/refused/*")
    return spark.read.schema(kept).parquet(*folders) if folders else spark.createDataFrame([], kept)


def _versions_in(spark: SparkSession, folder: str) -> list[int]:
    return [int(name.rsplit("=", 1)[1]) for name in child_names(spark, f"{folder}/{VERSION}=*")]


def pending_files(spark: SparkSession, feed: Feed, table: str) -> DataFrame:
    """(path, version) of the files in the landing area that no commit has taken."""
    taken = ledger(spark, table).select("path")
    return files_present(spark, feed.source, feed.pattern).join(taken, "path", "left_anti")


def land(spark: SparkSession, feed: Feed, table: str, max_files: int | None = None) -> list[int]:
    """Stores the deliveries not taken yet, oldest first, and returns their versions.

    Only pending names come to the driver, which has to list the files of a scan anyway.
    """
    files = pending_files(spark, feed, table).collect()
    unnamed = sorted(f.path for f in files if f.version is None)
    if unnamed and feed.on_unnamed == "error":
        raise ValueError(f"{len(unnamed)} files carry no version in their names, for example {unnamed[:5]}")
    versions = sorted({f.version for f in files if f.version is not None})[:max_files]
    if not versions:
        if not _last_commit(spark, table):
            raise FileNotFoundError(f"no delivery matches {feed.source}")
        return []
    chosen = [(f.path, f.version) for f in files if f.version in set(versions)]
    # A predicate on file metadata: other files are not opened.
    rows = with_lineage(scan_csv(spark, feed.source, feed.schema), feed.pattern).filter(
        F.col("_metadata.file_path").isin([path for path, _ in chosen])
    )
    store_delivery(feed, rows, table, spark.createDataFrame(chosen, "path string, version long"))
    return versions


def delivered(spark: SparkSession, feed: Feed, table: str, numbers: Sequence[int]) -> DataFrame:
    """The rows of some commits, as they were delivered."""
    folders = [f"{table}/deliveries/commit={n}" for n in numbers]
    rows = spark.read.schema(feed.stored).option("basePath", f"{table}/deliveries").parquet(*folders)
    return rows.select(*feed.stored.names)


def first_version(spark: SparkSession, table: str, number: int) -> int:
    """The least version in a commit."""
    return min(_versions_in(spark, f"{table}/deliveries/commit={number}"), default=0)


def bronze(spark: SparkSession, feed: Feed, table: str) -> DataFrame:
    """The table's current content: the last snapshot merged with the deliveries committed since.

    Malformed lines are beside the merge: they are rows of their own and never replace one.
    """
    snapshots = committed(spark, table, "snapshots")
    snapshot = snapshots[-1] if snapshots else None
    since = [n for n in committed(spark, table, "deliveries") if snapshot is None or n > snapshot]
    if not since:
        if snapshot is None:
            return spark.createDataFrame([], feed.stored)
        return spark.read.schema(feed.stored).parquet(f"{table}/snapshots/commit={snapshot}")

    tail = delivered(spark, feed, table, since)
    if snapshot is None:
        # What the table began with: the oldest delivery of the first commit.
        first, begun = first_version(spark, table, since[0]), delivered(spark, feed, table, since[:1])
        base, rest = begun.filter(F.col(VERSION) == first), begun.filter(F.col(VERSION) != first)
        tail = rest.unionByName(delivered(spark, feed, table, since[1:])) if len(since) > 1 else rest
    else:
        base = spark.read.schema(feed.stored).parquet(f"{table}/snapshots/commit={snapshot}")
    formed = F.col(CORRUPT).isNull()
    # Later versions of a key replace earlier ones before the merge, so any number of deliveries is one join.
    updates = latest_per_key(tail.filter(formed), feed.keys, [VERSION])
    merged = upsert(base.filter(formed), updates, feed.keys, newer_by=VERSION, small_updates=is_small(tail))
    return merged.unionByName(base.filter(~formed)).unionByName(tail.filter(~formed))


def compact(
    spark: SparkSession, feed: Feed, table: str, write: Callable[[DataFrame, str], object] | None = None
) -> None:
    """Writes the current content as the next snapshot; nothing to do when the last one is current.

    `write` takes the frame and the folder, for a write that does more, such as counting or publishing.
    """
    done = committed(spark, table, "deliveries")
    if done and done[-1] > max(committed(spark, table, "snapshots"), default=-1):
        folder = f"{table}/snapshots/commit={done[-1]}"
        write = write or (lambda df, path: df.write.mode("overwrite").parquet(path))
        write(bronze(spark, feed, table), folder)
        commit_marker(spark, folder)


def expire(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Deletes all but the last `keep` snapshots, and the deliveries the oldest of those contains. The ledger stays."""
    snapshots = committed(spark, table, "snapshots")
    for n in snapshots[:-keep]:
        delete_folder(spark, f"{table}/snapshots/commit={n}")
    if snapshots:
        oldest = snapshots[-keep:][0]
        for n in committed(spark, table, "deliveries"):
            if n <= oldest:
                delete_folder(spark, f"{table}/deliveries/commit={n}")


def ingest(
    spark: SparkSession, feed: Feed, table: str, max_files: int | None = None, reset: bool = False
) -> DataFrame:
    """Lands what is pending and returns bronze; reset starts the table over, as test runs do."""
    if reset:
        delete_folder(spark, table)
    land(spark, feed, table, max_files)
    return bronze(spark, feed, table)
