"""Random-forest training, tuning, scoring and inspection with Spark ML."""

import math
import random
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.cleaning import columns_of_type
from tideline.operators.runs import run_rows

# --- fixed values ------------------------------------------------------------------------------------
LEAST_MAX_BINS = 40
SEED = 42
MOST_CATEGORIES = 10_000
TRAINING_PARTITIONS = 16
PARTITION_ROWS = 1_000_000
# -----------------------------------------------------------------------------------------------------


def indexer(df: DataFrame, columns: Sequence[str] | None = None) -> StringIndexer:
    """Indexes categories as <column>_Index by falling frequency; rows with an unseen category are skipped."""
    columns = list(columns or columns_of_type(df, T.StringType))
    return StringIndexer(inputCols=columns, outputCols=[f"{c}_Index" for c in columns], handleInvalid="skip")


def feature_stages(df: DataFrame, label: str) -> Pipeline:
    """String columns indexed and, with all double columns but the label, assembled into `features`.

    Integer columns are not features: conform them to double where they should be.
    """
    categories = columns_of_type(df, T.StringType)
    numbers = columns_of_type(df, T.DoubleType, exclude=[label])
    assembler = VectorAssembler(inputCols=[f"{c}_Index" for c in categories] + numbers, outputCol="features")
    return Pipeline(stages=[indexer(df, categories), assembler] if categories else [assembler])


def forest(features: PipelineModel, label: str, **params) -> RandomForestRegressor:
    """The regressor, with enough bins for the widest category seen."""
    widest = max((len(labels) for labels in getattr(features.stages[0], "labelsArray", [])), default=0)
    return RandomForestRegressor(labelCol=label, maxBins=max(LEAST_MAX_BINS, widest), seed=SEED, **params)


def check_categories(df: DataFrame, columns: Sequence[str], most: int = MOST_CATEGORIES) -> None:
    """Raises for a column with clearly more than `most` categories: its labels and bins would not stay small.

    Counted by a sketch, so no label reaches the driver before the check.
    """
    if not columns:
        return
    counts = df.agg(*(F.approx_count_distinct(c).alias(c) for c in columns)).first().asDict()
    wide = {c: n for c, n in counts.items() if n > 1.1 * most}
    if wide:
        raise ValueError(f"too many categories for a feature (limit {most}): {wide}")


def training_partitions(df: DataFrame) -> int:
    """So many that one holds about PARTITION_ROWS rows, at least TRAINING_PARTITIONS: only the rows decide."""
    return max(TRAINING_PARTITIONS, math.ceil(df.count() / PARTITION_ROWS))


def dealt(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt by the hash of their columns and sorted: the forest bags by partition and place, so the same rows
    and the same number of partitions give the same model on any cluster. Without a number it grows with the rows."""
    return df.repartition(partitions or training_partitions(df), *df.columns).sortWithinPartitions(*df.columns)


def fitted_features(df: DataFrame, label: str) -> PipelineModel:
    check_categories(df, columns_of_type(df, T.StringType))
    return feature_stages(df, label).fit(df)


def train(df: DataFrame, label: str, partitions: int | None = None, **params) -> PipelineModel:
    """Fits indexer, assembler and forest as one model. Features are prepared once for all passes of the fit."""
    features = fitted_features(df, label)
    prepared = features.transform(dealt(df, partitions)).select("features", label)
    prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = forest(features, label, **params).fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel(stages=[*features.stages, fitted])


def score(model: PipelineModel | str, df: DataFrame) -> DataFrame:
    """`df` with predictions, by a fitted model or the path of a saved one."""
    return (PipelineModel.load(model) if isinstance(model, str) else model).transform(df)


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def feature_importance(model: PipelineModel, scored: DataFrame, features: str = "features") -> DataFrame:
    """(idx, name, score) per feature, the most important first; names come from the vector's metadata."""
    attributes = scored.schema[features].metadata["ml_attr"]["attrs"]
    importances = model.stages[-1].featureImportances
    rows = [(a["idx"], a["name"], float(importances[a["idx"]])) for group in attributes.values() for a in group]
    schema = "idx int, name string, score double"
    return scored.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("score"), "idx")


@dataclass(frozen=True)
class Quantized:
    """Uniform draws from start to end in steps."""

    start: int
    end: int
    step: int = 1

    def draw(self, rng: random.Random) -> int:
        return self.start + self.step * rng.randint(0, (self.end - self.start) // self.step)


# --- fixed values: the search space ------------------------------------------------------------------
FOREST_SPACE = {"numTrees": Quantized(2, 10), "maxDepth": Quantized(10, 30)}
# -----------------------------------------------------------------------------------------------------


@dataclass
class Tuning:
    runs: DataFrame
    best: dict[str, int]
    model: PipelineModel
    trials: list[dict] = field(default_factory=list)


def candidates(space: Mapping[str, Quantized], count: int, seed: int = SEED) -> list[dict[str, int]]:
    """Seeded draws from the space, without repeats as long as it has fresh points."""
    rng = random.Random(seed)
    points = 1
    for axis in space.values():
        points *= (axis.end - axis.start) // axis.step + 1
    drawn: list[dict[str, int]] = []
    while len(drawn) < count:
        point = {name: axis.draw(rng) for name, axis in space.items()}
        if point not in drawn or len(drawn) >= points:
            drawn.append(point)
    return drawn


def tune(
    training: DataFrame,
    validation: DataFrame,
    label: str,
    evaluations: int,
    space: Mapping[str, Quantized] = FOREST_SPACE,
    model_folder: str | None = None,
    parallelism: int = 2,
    run_name: str = "forest",
    partitions: int | None = None,
) -> Tuning:
    """Fits `evaluations` forests and keeps the one with the least validation RMSE.

    Features are prepared once and shared by all fits; fits overlap on the cluster. Each trial logs its
    parameters and its error on both parts, to show overfitting, and is saved when a folder is given.
    """
    features = fitted_features(training, label)
    prepared = [features.transform(df).select("features", label) for df in (dealt(training, partitions), validation)]
    for df in prepared:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    regressor = forest(features, label)
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    parent = uuid.uuid4().hex

    def trial(params: dict[str, int]) -> dict:
        started = datetime.now(timezone.utc)
        fitted: RandomForestRegressionModel = regressor.copy({regressor.getParam(k): v for k, v in params.items()}).fit(
            prepared[0]
        )
        errors = [evaluator.evaluate(fitted.transform(df)) for df in prepared]
        run_id = uuid.uuid4().hex
        model = PipelineModel(stages=[*features.stages, fitted])
        path = save(model, f"{model_folder.rstrip('/')}/{run_id}") if model_folder else None
        metrics = {"rmse_train": errors[0], "rmse_validation": errors[1]}
        return dict(run_id=run_id, parent_id=parent, started_at=started, params=params, metrics=metrics,
                    model=model, model_path=path)

    try:
        with ThreadPool(parallelism) as pool:
            trials = pool.map(trial, candidates(space, evaluations))
    finally:
        for df in prepared:
            df.unpersist()
    best = min(trials, key=lambda t: t["metrics"]["rmse_validation"])
    summary = dict(run_id=parent, parent_id=None, started_at=trials[0]["started_at"], params=best["params"],
                   metrics=best["metrics"], model_path=best["model_path"])
    runs = run_rows(training.sparkSession, [summary, *trials], run_name)
    return Tuning(runs, best["params"], best["model"], trials)
