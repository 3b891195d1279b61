"""Rows a model cannot score: capture them and report why."""

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labels of a column up to which they are broadcast.
BROADCAST_LABELS = 100_000

def unseen_rows(incoming: DataFrame, scored: DataFrame) -> DataFrame:
    """Distinct incoming rows without a counterpart in the scored output, nulls comparing equal.

    Both sides are made distinct on the map side first, so a row that repeats often loads no task.
    """
    return incoming.distinct().subtract(scored.select(*incoming.columns).distinct())


def model_labels(model: PipelineModel) -> dict[str, list[str]]:
    """The categories per column that the model's indexers were fitted on."""
    found = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            columns = stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
            found.update(zip(columns, stage.labelsArray))
    return found


def model_numbers(model: PipelineModel) -> list[str]:
    """The numeric columns that the model's assemblers read, less those its indexers make."""
    indexed = {c for s in model.stages if isinstance(s, StringIndexerModel) for c in s.getOutputCols()}
    return [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols() if c not in indexed]


def _marked(incoming: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """`incoming` and `_scorable`: whether every categorical column holds a category seen in training.

    Labels are distinct, so the joins add no row. They are what the driver already holds of the fitted model; lists of
    up to BROADCAST_LABELS are sent to the tasks, longer ones are joined.
    """
    spark, columns = incoming.sparkSession, incoming.columns
    marked = incoming.select("*", F.lit(True).alias("_scorable"))
    for column, values in labels.items():
        known = spark.createDataFrame([(v,) for v in dict.fromkeys(values)], "_label string")
        known = F.broadcast(known) if len(values) <= BROADCAST_LABELS else known
        found = F.col("_scorable") & F.col("_label").isNotNull()
        marked = marked.join(known, F.col(column).cast("string") == F.col("_label"), "left").select(
            *columns, found.alias("_scorable")
        )
    return marked


def unscorable_rows(incoming: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same rows as `unseen_rows` on the model's output, without scoring or comparing whole rows.

    Whether a row is skipped depends on its categories alone, so only those few rows are deduplicated.
    """
    return _marked(incoming, labels).filter(~F.col("_scorable")).drop("_scorable").dropDuplicates()


def scorable_rows(incoming: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows the model can score, in their columns."""
    return _marked(incoming, labels).filter("_scorable").drop("_scorable")


def known_categories(training: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The training categories as a table (column, category), to report against without a model."""
    cast = training.select(*(F.col(c).cast("string").alias(c) for c in columns))
    return (
        cast.unpivot([], list(columns), "column", "category").filter("category IS NOT NULL").distinct()
    )


def unseen_by_category(incoming: DataFrame, training: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, category) whose category is absent from the training data, nulls included.

    Both sides are reduced to distinct categories before they meet, so a hot category costs one row.
    """
    cast = incoming.select(*(F.col(c).cast("string").alias(c) for c in columns))
    counted = (
        cast.unpivot([], list(columns), "column", "category")
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counted.join(known_categories(training, columns), ["column", "category"], "left_anti")
