"""The run log: parameters and metrics per training run, as rows."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_name string, run_id string, parent_id string, started_at timestamp, "
    "kind string, key string, value double, model_path string"
)


def run_rows(spark: SparkSession, runs: Sequence[Mapping], run_name: str) -> DataFrame:
    """(run, kind, key, value) rows; a few per run, whatever the size of the data."""
    rows = [
        (run_name, r["run_id"], r["parent_id"], r["started_at"], kind, key, float(value), r["model_path"])
        for r in runs
        for kind, values in (("param", r["params"]), ("metric", r["metrics"]))
        for key, value in values.items()
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def newest_per_group(df: DataFrame, group: str, started: str, tie: str) -> DataFrame:
    """The row that started last per group, one aggregate and no sort. Ties go to the greatest `tie`."""
    rest = [c for c in df.columns if c not in (group, started, tie)]
    newest = F.max_by(F.struct(started, tie, *rest), F.struct(started, tie)).alias("_newest")
    return df.groupBy(group).agg(newest).select(group, "_newest.*").select(*df.columns)


def latest_model(runs: DataFrame, run_name: str) -> DataFrame:
    """(model_path): the newest saved model of an experiment, as one row."""
    saved = runs.filter((F.col("run_name") == run_name) & F.col("model_path").isNotNull())
    return saved.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1).select("model_path")
