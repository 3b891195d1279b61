"""Deliveries as a stream: file source, checkpointed, into a table or a keyed upsert."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.versions import VERSION_PATTERN
from tideline.operators.expectations import ExpectationFailed
from tideline.schemas import LINEAGE
from tideline.sources.files import CORRUPT, VERSION, with_corrupt, with_lineage
from tideline.sources.ingest import Feed, ledger, refuse, store_delivery


def file_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    file_format: str = "csv",
    pattern: str = VERSION_PATTERN,
    max_files: int | None = None,
) -> DataFrame:
    """New files below a folder as a stream, with lineage. The schema is declared, never inferred."""
    reader = spark.readStream.format(file_format).option("recursiveFileLookup", True)
    if file_format == "csv":
        schema = with_corrupt(schema)
        reader = reader.option("header", True).option("enforceSchema", False)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_lineage(reader.schema(schema).load(source), pattern)


def stream_to_table(stream: DataFrame, name: str, checkpoint: str, path: str | None = None) -> StreamingQuery:
    """Appends what is new to a parquet table and stops; the checkpoint remembers the files taken."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    return writer.trigger(availableNow=True).toTable(name)


def stream_deliveries(
    spark: SparkSession, feed: Feed, table: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Lands new files into the table that `bronze` reads, one commit per micro-batch.

    The ledger names the batch, so one that is replayed after its commit is passed over, and one that died before it is
    done again. Files that the ledger knows from a batch run or another checkpoint are left out. A micro-batch that violates
    a 'fail' rule of the feed is refused as a whole, noted, and stays invisible; set max_files to 1 to refuse single files.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        name, session = f"{checkpoint}#{batch_id}", batch.sparkSession
        taken = ledger(session, table)
        if not taken.filter(F.col("batch") == name).isEmpty():
            return
        if feed.on_unnamed == "error" and (stray := batch.filter(F.col(VERSION).isNull()).select(LINEAGE).first()):
            raise ValueError(f"a file carries no version in its name: {stray[0]}")
        new = batch.filter(F.col(VERSION).isNotNull()).join(
            taken.select(F.col("path").alias(LINEAGE)).distinct(), LINEAGE, "left_anti"
        )
        if new.isEmpty():
            return
        try:
            store_delivery(feed, new, table, batch=name)
        except ExpectationFailed as failed:
            files = new.select(F.col(LINEAGE).alias("path"), F.col(VERSION).alias("version")).distinct()
            refuse(files, failed.violations, table, name)

    stream = file_stream(spark, feed.source, feed.schema, pattern=feed.pattern, max_files=max_files)
    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
