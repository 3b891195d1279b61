import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.listings import frame, listing
from tideline.operators.columns import conform
from tideline.operators.gold import to_gold
from tideline.operators.metrics import rmse, target_profile
from tideline.operators.model import (
    FOREST_SPACE,
    Quantized,
    candidates,
    check_categories,
    feature_importance,
    feature_stages,
    forest,
    save,
    score,
    train,
    tune,
)
from tideline.operators.runs import append_runs, latest_model, newest_per_group
from tideline.operators.sampling import bernoulli_sample, hash_sample, hash_split, random_split, with_split
from tideline.operators.unseen import (
    model_labels,
    scorable_rows,
    unscorable_rows,
    unseen_by_category,
    unseen_rows,
)
from tideline.operators import model as models
from tideline.operators import unseen
from tideline.plans.daily import DailyTables, monitor, score_daily
from tideline.schemas import COMPOSITE, REVIEW_SCORES, SCORING_SCHEMA


@pytest.fixture(scope="module")
def gold(spark):
    rows = [listing(i, cancellation_policy="strict" if i % 4 else "flexible", accommodates=float(i % 7)) for i in range(200)]
    return conform(to_gold(frame(spark, rows), REVIEW_SCORES, COMPOSITE), SCORING_SCHEMA).cache()


@pytest.fixture(scope="module")
def model(gold):
    return train(gold, "price", numTrees=3, maxDepth=4)


def test_round_trip_of_a_trained_model(spark, gold, model, tmp_path):
    path = save(model, str(tmp_path / "model"))
    loaded = PipelineModel.load(path)
    predicted = score(loaded, gold)
    assert predicted.count() == 200
    assert {f"{c}_Index" for c in model_labels(model)} <= set(predicted.columns)
    assert score(path, gold).first().prediction == score(model, gold).first().prediction


def test_features_are_indexes_and_doubles_without_the_target(gold):
    stages = feature_stages(gold.withColumn("whole", F.lit(1)), "price").getStages()
    inputs = stages[1].getInputCols()
    assert "price" not in inputs and "whole" not in inputs
    assert inputs[0] == "host_is_superhost_Index" and "latitude" in inputs


def test_bins_grow_with_the_widest_category(spark):
    df = spark.range(100).selectExpr("cast(id AS string) AS s", "cast(id AS double) AS price")
    features = feature_stages(df, "price").fit(df)
    assert forest(features, "price").getMaxBins() == 100
    assert train(df, "price", numTrees=2, maxDepth=2)


def test_importance_is_sorted_and_named(gold, model):
    ranked = feature_importance(model, score(model, gold)).collect()
    assert [r.score for r in ranked] == sorted((r.score for r in ranked), reverse=True)
    assert sum(r.score for r in ranked) == pytest.approx(1.0)
    assert "latitude" in {r.name for r in ranked}


def test_candidates_are_seeded_and_in_range():
    drawn = candidates(FOREST_SPACE, 20)
    assert drawn == candidates(FOREST_SPACE, 20)
    assert all(2 <= p["numTrees"] <= 10 and 10 <= p["maxDepth"] <= 30 for p in drawn)
    assert len({tuple(p.values()) for p in drawn}) == 20
    assert len(candidates({"numTrees": Quantized(2, 3)}, 5)) == 5


def test_tuning_logs_every_trial_and_finds_the_best(spark, gold, tmp_path):
    parts = hash_split(gold, ["longitude", "latitude"], {"train": 0.6, "validation": 0.2, "test": 0.2})
    space = {"numTrees": Quantized(2, 4), "maxDepth": Quantized(2, 4)}
    done = tune(parts["train"], parts["validation"], "price", 3, space, str(tmp_path / "models"), run_name="listing")
    errors = [t["metrics"]["rmse_validation"] for t in done.trials]
    assert done.best in [t["params"] for t in done.trials if t["metrics"]["rmse_validation"] == min(errors)]
    assert done.runs.count() == 4 * 4
    append_runs(done.runs, str(tmp_path / "runs"))
    append_runs(done.runs, str(tmp_path / "runs"))
    stored = spark.read.parquet(str(tmp_path / "runs"))
    newest = latest_model(stored, "listing").first().model_path
    assert score(newest, parts["test"]).count() == parts["test"].count()


def test_newest_per_group(spark, rows):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 1, 1, "w")], "g string, at int, tie int, v string")
    assert rows(newest_per_group(df, "g", "at", "tie")) == [("a", 2, 2, "z"), ("b", 1, 1, "w")]


def test_rmse_and_profile(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 0.0, 0.0)], "g string, price double, prediction double")
    assert rows(rmse(df, "price", by=["g"])) == [("a", math.sqrt(2.5)), ("b", 0.0)]
    assert rmse(df, "price").first().rmse == pytest.approx(math.sqrt(5 / 3))
    assert rows(target_profile(df, "g", "price")) == [("a", 2, 1.0, 1.0, 1.0), ("b", 1, 0.0, 0.0, 0.0)]


# --- rows the model cannot score ---


def daily_rows(gold):
    unknown = gold.limit(3).withColumn("cancellation_policy", F.lit("Random Policy"))
    null = gold.limit(2).withColumn("cancellation_policy", F.lit(None).cast("string"))
    return gold.unionByName(unknown).unionByName(null).unionByName(unknown)


def test_unseen_rows_agree_with_the_label_filter(gold, model, rows):
    daily = daily_rows(gold)
    scored = score(model, daily)
    assert scored.count() == 200
    missing = unseen_rows(daily, scored)
    assert missing.count() == 5
    labels = model_labels(model)
    assert rows(unscorable_rows(daily, labels)) == rows(missing)
    assert rows(scorable_rows(daily, labels)) == rows(scored.select(*daily.columns))
    assert unscorable_rows(gold, labels).isEmpty()


def test_long_label_lists_are_joined(gold, model, rows, monkeypatch):
    labels = model_labels(model)
    short = [rows(f(daily_rows(gold), labels)) for f in (unscorable_rows, scorable_rows)]
    monkeypatch.setattr(unseen, "BROADCAST_LABELS", 0)
    assert [rows(f(daily_rows(gold), labels)) for f in (unscorable_rows, scorable_rows)] == short


def test_labels_of_a_numeric_column(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 1)], "p string, q int")
    assert scorable_rows(df, {"q": ["1"]}).columns == ["p", "q"]
    assert rows(scorable_rows(df, {"q": ["1"]})) == [("a", 1), (None, 1)]
    assert rows(unscorable_rows(df, {"q": ["1"], "p": ["a"]})) == [("b", 2), (None, 1)]


def test_a_missing_number_is_captured(spark, gold, model, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS broken LOCATION '{tmp_path}/broken'")
    names = DailyTables(**{f: f"broken.{f}" for f in DailyTables.__dataclass_fields__})
    beds = F.when(F.col("latitude") == gold.first()["latitude"], "n/a").otherwise(F.col("beds").cast("string"))
    predictions = score_daily(gold.withColumn("beds", beds), model, names)
    assert predictions.count() + spark.table(names.unseen).count() == gold.count()
    assert spark.table(names.unseen).filter("beds IS NULL").count() >= 1


def test_the_model_does_not_depend_on_the_partitioning(gold):
    found = [train(gold.repartition(n), "price", numTrees=3, maxDepth=3) for n in (1, 7)]
    assert found[0].stages[-1].featureImportances == found[1].stages[-1].featureImportances


def test_too_many_categories_are_refused(gold):
    with pytest.raises(ValueError, match="categories"):
        check_categories(gold.withColumn("room_type", F.col("latitude").cast("string")), ["room_type"], most=3)


def test_unseen_by_category_counts_rows(gold, rows):
    found = unseen_by_category(daily_rows(gold), gold, ["cancellation_policy", "room_type"])
    assert rows(found) == [("cancellation_policy", "Random Policy", 6), ("cancellation_policy", None, 2)]


def test_daily_run(spark, gold, model, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS daily LOCATION '{tmp_path}/daily'")
    names = DailyTables(**{f: f"daily.{f}" for f in DailyTables.__dataclass_fields__})
    predictions = score_daily(daily_rows(gold), model, names)
    assert predictions.count() == 200
    assert spark.table(names.unseen).count() == 5
    # The next day brings one more unknown row elsewhere, and a change to one that is known already.
    unknown = gold.orderBy("latitude").withColumn("cancellation_policy", F.lit("Other Policy"))
    known = spark.table(names.unseen).orderBy(F.desc("latitude")).limit(1).withColumn("beds", F.lit(7.0))
    next_day = unknown.limit(1).withColumn("latitude", F.lit(-1.0)).unionByName(known)
    assert score_daily(next_day, model, names).count() == 0
    assert spark.table(names.unseen).count() == 6
    assert spark.table(names.unseen).filter("beds = 7").count() == 1
    predictions = score_daily(gold, model, names)
    flags = monitor(gold, gold.withColumn("latitude", F.col("latitude") + 500), predictions, tables=names, run_date="2024-01-31")
    data = spark.table(flags["data"])
    assert data.dtypes == [("date", "string"), ("drift_detected", "boolean")] and data.count() == 1
    assert spark.table(flags["target"]).columns == ["date", "model_drift_detected"]
    report = {r.column: r.drifted for r in spark.table(names.data_drift_report).collect()}
    assert report["latitude"] and not report["room_type"] and "price" not in report


def test_score_is_corrected_before_scoring(spark, gold, model, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS corrected LOCATION '{tmp_path}/corrected'")
    names = DailyTables(**{f: f"corrected.{f}" for f in DailyTables.__dataclass_fields__})
    predictions = score_daily(gold, model, names, correction=(COMPOSITE, "review_scores_rating"))
    assert predictions.first()[COMPOSITE] == gold.first()[COMPOSITE] - 2.0
    assert not spark.catalog.tableExists(names.unseen)


# --- samples and splits ---


def test_hash_split_is_whole_disjoint_and_stable(spark, rows):
    df = spark.range(5000).withColumnRenamed("id", "k")
    weights = {"train": 0.6, "validation": 0.2, "test": 0.2}
    parts = hash_split(df, ["k"], weights)
    assert sum(p.count() for p in parts.values()) == 5000
    assert parts["train"].intersect(parts["test"]).isEmpty()
    assert abs(parts["train"].count() - 3000) < 150
    labelled = with_split(df.repartition(7), ["k"], weights)
    assert rows(labelled.filter("split = 'test'").select("k")) == rows(parts["test"])
    assert rows(hash_sample(df, ["k"], 0.6)) == rows(parts["train"])
    assert rows(hash_sample(df, ["k"], 0.6, seed="other")) != rows(parts["train"])
    assert hash_sample(df, ["k"], 1.0).count() == 5000


def test_spark_samples(spark):
    df = spark.range(1000)
    assert bernoulli_sample(df, 1.0, 3).count() == 1000
    assert bernoulli_sample(df, 0.1, 3).count() == bernoulli_sample(df, 0.1, 3).count()
    assert sum(p.count() for p in random_split(df, [0.6, 0.2, 0.2], 42)) == 1000


def test_training_partitions_grow_with_the_rows(spark, monkeypatch):
    """A partition holds a bounded number of rows; small tables are dealt as before, and a given number holds."""
    df = spark.range(500).selectExpr("cast(id AS double) AS x")
    assert models.dealt(df).rdd.getNumPartitions() == models.TRAINING_PARTITIONS
    monkeypatch.setattr(models, "PARTITION_ROWS", 10)
    assert models.dealt(df).rdd.getNumPartitions() == 50
    assert models.dealt(df, 3).rdd.getNumPartitions() == 3
