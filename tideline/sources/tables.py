"""Catalog tables: scan, overwrite, publish behind a gate, create or upsert."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.expectations import ExpectationFailed, Rule, check_observed, observed, with_violated
from tideline.operators.upsert import DuplicateKeys, ambiguous_matches, duplicate_keys, is_small, upsert
from tideline.workspace import create_folder, delete_folder, new_table_folder

# Providers whose tables Spark can merge into row by row.
MERGING_PROVIDERS = {"delta", "iceberg", "hudi"}


def scan_table(spark: SparkSession, name: str, fraction: float = 1.0, seed: int | None = None) -> DataFrame:
    """The whole table, or a Bernoulli sample of it."""
    table = spark.table(name)
    return table if fraction >= 1.0 else table.sample(fraction=fraction, seed=seed)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replaces the table's content in one step: readers see the old rows or the new ones, never none."""
    publish(df, name, keep_previous=False)


def publish(
    df: DataFrame,
    name: str,
    rules: Sequence[Rule] = (),
    comment: str | None = None,
    folder: str | None = None,
    keep_previous: bool = True,
) -> dict[str, int]:
    """Writes `df` to a new folder, counting rule violations on the way, then points the table at it.

    Tables lie below their database's location unless a folder is given. The frame may read the table it replaces. If a
    'fail' rule is violated the table keeps its old content.
    The replaced folder stays for readers still on it, unless keep_previous is off. Returns the violations per rule.
    """
    spark = df.sparkSession
    folder = folder or new_table_folder(spark, name)
    previous = _detail(spark, name, "Location") if spark.catalog.tableExists(name) else None
    violations: dict[str, int] = {}
    if rules:
        watched, observation = observed(df, list(rules))
        watched.write.mode("overwrite").parquet(folder)
        try:
            violations = check_observed(observation, list(rules))
        except ExpectationFailed:
            delete_folder(spark, folder)
            raise
    else:
        df.write.mode("overwrite").parquet(folder)
    _point_at(spark, name, folder, df, comment)
    if previous and not keep_previous:
        delete_folder(spark, previous)
    return violations


VIOLATED = "_violated"


def publish_passing(df: DataFrame, name: str, rules: Sequence[Rule]) -> tuple[dict[str, int], DataFrame]:
    """Publishes the rows that violate no 'drop' rule, and keeps the others, with the names of those they violate.

    One pass writes both, to two partitions of one folder, and counts every rule; the table is pointed at the one of
    the passing rows. A violated 'fail' rule, over all rows, leaves the table as it was. Returns the violations per rule
    and the refused rows with `_violated`. The replaced folder stays.
    """
    spark, rule_list = df.sparkSession, list(rules)
    if clash := {VIOLATED, "_refused"} & set(df.columns):
        raise ValueError(f"columns are kept for the refused rows: {sorted(clash)}")
    folder = new_table_folder(spark, name)
    watched, observation = observed(df, rule_list)
    marked = with_violated(watched, rule_list, VIOLATED).withColumn("_refused", F.size(VIOLATED) > 0)
    marked.write.mode("overwrite").partitionBy("_refused").parquet(folder)
    try:
        violations = check_observed(observation, rule_list)
    except ExpectationFailed:
        delete_folder(spark, folder)
        raise
    for part in ("true", "false"):
        create_folder(spark, f"{folder}/_refused={part}")
    _point_at(spark, name, f"{folder}/_refused=false", df, None)
    refused = spark.read.schema(marked.drop("_refused").schema).parquet(f"{folder}/_refused=true")
    return violations, refused


def _detail(spark: SparkSession, name: str, key: str) -> str | None:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == key).first()
    return found.data_type if found else None


def _point_at(spark: SparkSession, name: str, folder: str, df: DataFrame, comment: str | None) -> None:
    if spark.catalog.tableExists(name):
        if [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema, description=comment)


def drop_table(spark: SparkSession, name: str) -> None:
    """Reset of a test namespace; quiet when there is nothing to drop."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_or_upsert(updates: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Creates the table from the first batch, else merges the batch into it.

    Where the table's provider merges rows, Spark's MERGE rewrites only what matched. A parquet table is merged
    into a new folder.
    """
    spark = updates.sparkSession
    if not spark.catalog.tableExists(name):
        publish(updates, name)
    elif (_detail(spark, name, "Provider") or "").lower() in MERGING_PROVIDERS:
        same_key = reduce(lambda a, b: a & b, (F.col(f"{name}.{k}") == F.col(f"updates.{k}") for k in keys))
        updates.alias("updates").mergeInto(name, same_key).whenMatched().updateAll().whenNotMatched().insertAll().merge()
    else:
        target = spark.table(name)
        repeated = not duplicate_keys(updates, keys).isEmpty()
        if repeated and not ambiguous_matches(target, updates, keys).isEmpty():
            raise DuplicateKeys(f"several rows of the batch match one row of {name} on {list(keys)}")
        publish(upsert(target, updates, keys, small_updates=is_small(updates)), name)
