"""The daily run: score the gold rows, capture what could not be scored, flag drift."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import schemas
from tideline.operators.columns import conform
from tideline.operators.drift import DriftSettings, dataset_flag, drift_report, flag_rows, target_drift_report
from tideline.operators.gold import correct_score
from tideline.operators.model import score
from tideline.operators.profile import Profile, report_against
from tideline.operators.unseen import model_labels, model_numbers, unscorable_rows
from tideline.sources.tables import create_or_upsert, overwrite_table
from tideline.workspace import delete_folder, new_folder


@dataclass(frozen=True)
class DailyTables:
    predictions: str = "default.daily_predictions"
    unseen: str = "default.unseen_rows"
    data_drift_report: str = "default.data_drift_report"
    data_drift_flag: str = "default.data_drift_flag"
    target_drift_report: str = "default.target_drift_report"
    target_drift_flag: str = "default.target_drift_flag"
    flag_history: str | None = None


def score_daily(
    daily: DataFrame,
    model: PipelineModel | str,
    tables: DailyTables = DailyTables(),
    schema: T.StructType = schemas.SCORING_SCHEMA,
    keys: Sequence[str] = tuple(schemas.LISTING_KEYS),
    correction: tuple[str, str] | None = None,
) -> DataFrame:
    """Writes the predictions and returns the written table; rows the model skips go to the unseen table.

    The prepared rows are written once and read by both. A row without a number that the model needs, as one that was
    no number in the delivery, can't be scored: it is captured too, and the others go on.

    correction = (composite, part) takes a part back out of the composite, for a model trained without it.
    """
    spark = daily.sparkSession
    model = PipelineModel.load(model) if isinstance(model, str) else model
    if correction:
        daily = correct_score(daily, *correction)
    folder = new_folder(spark, "daily")
    try:
        conform(daily, schema).write.parquet(folder)
        ready = spark.read.schema(schema).parquet(folder)
        complete = F.lit(True)
        for column in model_numbers(model):
            complete &= F.col(column).isNotNull() & ~F.isnan(column)
        # Vectors stay in memory; the table keeps what is read later.
        overwrite_table(score(model, ready.filter(complete)).drop("features"), tables.predictions)
        labels = model_labels(model)
        unseen = unscorable_rows(ready, labels).unionByName(ready.filter(~complete)).distinct()
        if not unseen.isEmpty():
            create_or_upsert(unseen, tables.unseen, keys)
    finally:
        delete_folder(spark, folder)
    return spark.table(tables.predictions)


def monitor(
    reference: DataFrame,
    daily: DataFrame,
    predictions: DataFrame,
    target: str = schemas.TARGET,
    current_column: str = "prediction",
    tables: DailyTables = DailyTables(),
    run_date: str | None = None,
    settings: DriftSettings = DriftSettings(),
    correction: tuple[str, str] | None = None,
    profile: Profile | None = None,
) -> Mapping[str, str]:
    """Writes the reports per column and the two one-row flag tables, reading each report back for its flag.

    With a stored profile of the reference both reports come from it and no row of `reference` is read. With a
    flag_history table the flags of the date are merged into it; `drift.turned_on` tells when one turned true.

    `correction` is the one given to `score_daily`: a score the model was trained on without a part is compared
    without it.
    """
    spark = daily.sparkSession
    if correction:
        daily = correct_score(daily, *correction)
    if profile:
        data_report = report_against(profile, daily, run_date, exclude=[target], settings=settings)
        scored = predictions.select(F.col(current_column).alias(target))
        target_report = report_against(profile, scored, run_date, settings=settings)
    else:
        data_report = drift_report(reference, daily, run_date, exclude=[target], settings=settings)
        target_report = target_drift_report(reference, predictions, target, current_column, run_date, settings)
    overwrite_table(data_report, tables.data_drift_report)
    overwrite_table(target_report, tables.target_drift_report)
    data = dataset_flag(spark.table(tables.data_drift_report), "drift_detected", settings)
    overwrite_table(data, tables.data_drift_flag)
    model = dataset_flag(spark.table(tables.target_drift_report), "model_drift_detected", settings)
    overwrite_table(model, tables.target_drift_flag)
    if tables.flag_history:
        flags = flag_rows(spark.table(tables.data_drift_flag), spark.table(tables.target_drift_flag))
        create_or_upsert(flags, tables.flag_history, ["date", "alert"])
    return {"data": tables.data_drift_flag, "target": tables.target_drift_flag}
