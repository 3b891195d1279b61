"""Delimited files: scan with a declared schema, lineage, and versions from file names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.versions import VERSION_PATTERN, file_version
from tideline.schemas import LINEAGE

CORRUPT = "_corrupt_record"
VERSION = "ingest_version"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """`schema` plus the text field that keeps a malformed line whole."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Comma-separated files with a header: one file, a glob, or a folder with everything below it.

    Without a schema every column is a string.
    With one, a line that does not fit is kept: its bad fields are null and its text is in `_corrupt_record`.
    Header names are checked against the schema.
    """
    reader = spark.read.option("sep", ",").option("header", True).option("recursiveFileLookup", True)
    if schema is None:
        return reader.csv(path)
    return (
        reader.schema(with_corrupt(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        .csv(path)
    )


def with_lineage(df: DataFrame, pattern: str = VERSION_PATTERN) -> DataFrame:
    """Adds the source file of each row and the version in its name."""
    path = F.col("_metadata.file_path")
    return df.withColumns({LINEAGE: path, VERSION: file_version(path, pattern)})


def files_present(spark: SparkSession, source: str, pattern: str = VERSION_PATTERN) -> DataFrame:
    """(path, version) of every file in the landing area. Lists names only; no file is opened.

    Paths are spelled as in the lineage column. Names that carry no version have a null one.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    path = F.col("_metadata.file_path")
    return listing.select(path.alias("path"), file_version(path, pattern).alias("version"))


def versions_present(spark: SparkSession, source: str, pattern: str = VERSION_PATTERN) -> list[int]:
    """Versions in the landing area, ascending."""
    found = files_present(spark, source, pattern).select("version").filter("version IS NOT NULL").distinct()
    return sorted(row.version for row in found.collect())


def high_water_mark(df: DataFrame, lineage: str = LINEAGE, pattern: str = VERSION_PATTERN) -> DataFrame:
    """One row (last_version): the greatest version as a number, null for an empty table.

    As text, version 9 would sort above version 10.
    """
    return df.agg(F.max(file_version(lineage, pattern)).alias("last_version"))
