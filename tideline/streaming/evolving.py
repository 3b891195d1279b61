"""A stream of delimited files whose columns grow: the schema is kept in a log beside the checkpoint.

The stream carries the names of new files. Each micro-batch reads its files once per distinct header, adds columns that are
new to the schema, and writes its own folder of the table, so a batch that is replayed replaces itself.
"""

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.versions import VERSION_PATTERN
from tideline.schemas import LINEAGE
from tideline.sources.files import CORRUPT, VERSION, with_lineage
from tideline.workspace import child_names

BATCH = "_batch"
RESCUED = "_rescued_data"


def schema_log(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_schemas"


def current_schema(spark: SparkSession, checkpoint: str, initial: T.StructType) -> T.StructType:
    """The last schema in the log, or the initial one. Types never change; columns are only added, at the end."""
    log = schema_log(checkpoint)
    kept = [int(p.split("version=")[1].split("/")[0]) for p in child_names(spark, f"{log}/version=*/_SUCCESS")]
    if not kept:
        return initial
    return T.StructType.fromJson(json.loads(spark.read.text(f"{log}/version={max(kept)}").first().value))


def _log_schema(spark: SparkSession, checkpoint: str, schema: T.StructType) -> None:
    # Numbered by its width, which only grows: a batch that is replayed writes the same entry.
    entry = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
    entry.write.mode("overwrite").text(f"{schema_log(checkpoint)}/version={len(schema)}")


def _by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The files in groups of equal first lines. Files without a line are in none."""
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    # A file's first block is read in order by one task.
    placed = lines.filter("start = 0").withColumn("place", F.monotonically_increasing_id())
    first = placed.groupBy("path").agg(F.min_by("value", "place").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [r.paths for r in groups.orderBy("header").collect()]


def _fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns in the schema's types. What does not fit is null there and kept in `_rescued_data` as JSON."""
    given, kept, rescued = set(df.columns), [], []
    for field in schema:
        if field.name not in given:
            kept.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        text = F.col(f"`{field.name}`")
        value = text.try_cast(field.dataType)
        kept.append(value.alias(field.name))
        rescued.append(F.when(text.isNotNull() & value.isNull(), F.create_map(F.lit(field.name), text)))
    rescued.append(F.when(F.col(CORRUPT).isNotNull(), F.create_map(F.lit(CORRUPT), F.col(CORRUPT))))
    none = F.create_map().cast("map<string,string>")
    found = reduce(F.map_concat, (F.coalesce(r, none) for r in rescued))
    return df.select(*kept, F.when(F.size(found) > 0, F.to_json(found)).alias(RESCUED), LINEAGE, VERSION)


def stream_evolving(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    hints: T.StructType | None = None,
    pattern: str = VERSION_PATTERN,
    max_files: int | None = None,
) -> StreamingQuery:
    """Appends new files below `source` to the parquet folder `path`, and adds the columns they bring to the schema.

    A new column gets its type from `hints`, else it is text. Names match whatever their case. A file may lack columns or
    have them in another order. A value that does not fit its type, and a line with more or fewer values than the
    header, loses nothing: the text goes to `_rescued_data`. Columns called as one of the table's own are refused. The
    names of a micro-batch's files come to the driver, as for any file scan; `max_files` bounds them.
    """
    own = {RESCUED.lower(), LINEAGE.lower(), VERSION.lower(), BATCH.lower(), CORRUPT.lower()}
    hinted = {f.name.lower(): f.dataType for f in hints or []}

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = [r.path for r in batch.select("path").distinct().collect()]
        groups = _by_header(session, paths) if paths else []
        known, headers = current_schema(session, checkpoint, schema), []
        before = len(known)
        for group in groups:
            named = {f.name.lower(): f.name for f in known}
            header = [named.get(c.lower(), c) for c in session.read.options(header=True, recursiveFileLookup=True).csv(group[0]).columns]
            if clash := own & {c.lower() for c in header}:
                raise ValueError(f"{group[0]} has columns that the table keeps for itself: {sorted(clash)}")
            for name in (c for c in header if c.lower() not in named):
                known = T.StructType([*known, T.StructField(name, hinted.get(name.lower(), T.StringType()))])
            headers.append(header)
        if len(known) > before:
            _log_schema(session, checkpoint, known)
        parts = []
        for header, group in zip(headers, groups):
            text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
            reader = session.read.schema(text).options(header=True, enforceSchema=True, recursiveFileLookup=True)
            rows = with_lineage(reader.option("columnNameOfCorruptRecord", CORRUPT).csv(group), pattern)
            parts.append(_fitted(rows, known))
        if parts:
            reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    listing = "path string, modificationTime timestamp, length long, content binary"
    names = spark.readStream.format("binaryFile").schema(listing).option("recursiveFileLookup", True)
    if max_files:
        names = names.option("maxFilesPerTrigger", max_files)
    return (
        names.load(source).select("path").writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_evolving(spark: SparkSession, path: str, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The table in the schema of the log: files older than a column have null there, and no file is opened to merge."""
    extra = [T.StructField(RESCUED, T.StringType()), T.StructField(LINEAGE, T.StringType()), T.StructField(VERSION, T.LongType())]
    stored = T.StructType([*current_schema(spark, checkpoint, schema), *extra])
    if not child_names(spark, f"{path}/{BATCH}=*"):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(path).select(*(F.col(f"`{c}`") for c in stored.names))
