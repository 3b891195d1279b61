"""Silver and gold kept up from the rows that each delivery changes, in place of recomputing them from all of bronze."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import schemas
from tideline.operators.clean import complete_rows
from tideline.operators.expectations import require
from tideline.operators.gold import to_gold
from tideline.plans.medallion import Layers, well_formed
from tideline.sources.buckets import BUCKET, CHANGE, maintain_bronze
from tideline.sources.counted import COMMIT, CountedRows, replace_buckets
from tideline.sources.files import CORRUPT, VERSION
from tideline.sources.ingest import Feed, commit_marker, committed
from tideline.workspace import child_names, delete_folder

LISTING_LAYERS = Layers(lineage=(VERSION, schemas.LINEAGE))


def maintain_layers(
    spark: SparkSession, feed: Feed, table: str, settings: Layers = LISTING_LAYERS, buckets: int = 64
) -> dict[str, DataFrame]:
    """Brings bronze, silver and gold up to the last committed delivery and returns them.

    They hold the rows that `layers(bronze(...))` computes. The work follows the delivery: the key buckets of bronze that
    it hits, the rows it changes, and the buckets of silver and gold that those lie in. Each layer has its own marker
    of the last change set in it; a run that died is taken up there. A violated fail rule of gold leaves gold as it
    was, and the changes stay due until a delivery mends the rows. Settings and buckets are those of the first call.
    """
    bronze = maintain_bronze(spark, feed, table, buckets)
    maintain_silver(spark, feed, table, settings, buckets)
    maintain_gold(spark, feed, table, settings, buckets)
    silver = maintained(spark, feed, table, "silver", settings)
    return {"bronze": bronze, "silver": silver, "gold": maintained(spark, feed, table, "gold", settings)}


def maintained(spark: SparkSession, feed: Feed, table: str, layer: str, settings: Layers = LISTING_LAYERS) -> DataFrame:
    """Silver or gold as last maintained."""
    schema = _silver_schema(feed)
    if layer == "gold":
        schema = _gold(spark.createDataFrame([], schema), settings).schema
    if not child_names(spark, f"{table}/{layer}/rows/{BUCKET}=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table}/{layer}/rows").select(*schema.names)


def maintain_silver(spark: SparkSession, feed: Feed, table: str, settings: Layers, buckets: int) -> None:
    """Counts the changed rows in, and rewrites the buckets of silver they lie in. Does not read bronze."""
    due = _due(spark, table, "silver")
    if not due:
        return
    state, path = _state(feed, table, settings, buckets), f"{table}/silver/rows"
    hit = state.apply(_changes(spark, feed, table, due, settings), due[-1])
    if hit:
        present, traced = state.present(spark, hit), [c for c in settings.lineage if c in _silver_schema(feed).names]
        rows = present.repartition(BUCKET)
        if traced:
            newest = F.max(F.struct(*traced)).alias("_newest")
            rows = rows.groupBy(BUCKET, *state.content).agg(newest).select(BUCKET, *state.content, "_newest.*")
        replace_buckets(rows.select(*_silver_schema(feed).names, BUCKET), path, hit, present)
    commit_marker(spark, f"{table}/silver/commit={due[-1]}")


def maintain_gold(spark: SparkSession, feed: Feed, table: str, settings: Layers, buckets: int) -> None:
    """Recomputes the buckets of gold whose silver changed, if their rows pass the rules. Change sets in gold go."""
    due = [n for n in _due(spark, table, "gold") if n <= max(committed(spark, table, "silver"), default=0)]
    if not due:
        return
    hit = _state(feed, table, settings, buckets).hit(_changes(spark, feed, table, due, settings))
    if hit and child_names(spark, f"{table}/silver/rows/{BUCKET}=*"):
        stored = T.StructType([*_silver_schema(feed).fields, T.StructField(BUCKET, T.IntegerType())])
        silver = spark.read.schema(stored).parquet(f"{table}/silver/rows").filter(F.col(BUCKET).isin(hit))
        gold = _gold(silver, settings)
        if settings.gold_rules:
            require(gold, list(settings.gold_rules))
        replace_buckets(gold, f"{table}/gold/rows", hit, silver)
    elif hit:
        for bucket in hit:
            delete_folder(spark, f"{table}/gold/rows/{BUCKET}={bucket}")
    commit_marker(spark, f"{table}/gold/commit={due[-1]}")
    for n in due:
        delete_folder(spark, f"{table}/changes/commit={n}")


def _due(spark: SparkSession, table: str, layer: str) -> list[int]:
    """Change sets that bronze has taken and the layer has not."""
    done, taken = max(committed(spark, table, layer), default=0), max(committed(spark, table, "bucketed"), default=0)
    return [n for n in committed(spark, table, "changes") if done < n <= taken]


def _changes(spark: SparkSession, feed: Feed, table: str, due: list[int], settings: Layers) -> DataFrame:
    """The changes among rows that silver would take: well formed, complete, not blank."""
    fields = [*feed.stored.fields, T.StructField(CHANGE, T.IntegerType()), T.StructField(COMMIT, T.LongType())]
    folders = [f"{table}/changes/{COMMIT}={n}" for n in due]
    read = spark.read.schema(T.StructType(fields)).option("basePath", f"{table}/changes").parquet(*folders)
    return complete_rows(well_formed(read), settings.lineage)


def _silver_schema(feed: Feed) -> T.StructType:
    return T.StructType([f for f in feed.stored.fields if f.name != CORRUPT])


def _state(feed: Feed, table: str, settings: Layers, buckets: int) -> CountedRows:
    content = [c for c in _silver_schema(feed).names if c not in settings.lineage]
    return CountedRows(f"{table}/silver/counted", content, buckets)


def _gold(silver: DataFrame, settings: Layers) -> DataFrame:
    return to_gold(silver, settings.scores, settings.composite, settings.target)
