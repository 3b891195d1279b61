import random
import shutil

import pytest

from tideline.operators import drift as D
from tideline.operators.profile import add_to_profile, read_profile, report_against, statistics_against, write_profile

SCHEMA = "x double, n int, `odd ``name` long, kind string, yes boolean, other date"


def rows(seed, n):
    rng = random.Random(seed)
    values = [None, float("nan"), float("inf"), -1e9, 0.0, -0.0, *(round(rng.gauss(seed, 2), 1) for _ in range(40))]
    return [
        (rng.choice(values), rng.choice([None, 1, 2, 3]), rng.randrange(1000), rng.choice(["a", "b", "", None, f"only {seed}"]), rng.random() < 0.3, None)
        for _ in range(n)
    ]


def content(df):
    return sorted((tuple(str(round(v, 9)) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("method", ["distance", "p-value"])
def test_equals_a_run_over_both_frames_without_reading_the_reference(spark, tmp_path, method):
    settings = D.DriftSettings(method=method, buckets=8)
    spark.createDataFrame(rows(1, 900), SCHEMA).write.parquet(str(tmp_path / "reference"))
    reference = spark.read.parquet(str(tmp_path / "reference"))
    current = spark.createDataFrame(rows(2, 500), SCHEMA)
    statistics = content(D.drift_statistics(reference, current, settings=settings))
    report = content(D.drift_report(reference, current, "2024-02-01", exclude=["n"], settings=settings))
    write_profile(reference, str(tmp_path / "profile"), settings=settings)
    shutil.rmtree(tmp_path / "reference")
    profile = read_profile(spark, str(tmp_path / "profile"))
    assert profile.numeric == ["x", "n", "odd `name"] and profile.categorical == ("kind", "yes")
    assert content(statistics_against(profile, current, settings=settings)) == statistics
    assert content(report_against(profile, current, "2024-02-01", exclude=["n"], settings=settings)) == report


def test_parts_add_up(spark, tmp_path):
    """Also where the second part has values far outside the first one's bounds."""
    first, second = rows(1, 300), [(1e12, 9, -5, "later", True, None), *rows(7, 400)]
    whole = spark.createDataFrame(first + second, SCHEMA)
    part = write_profile(spark.createDataFrame(first, SCHEMA), str(tmp_path / "a"))
    both = add_to_profile(part, spark.createDataFrame(second, SCHEMA), str(tmp_path / "b"))
    current = spark.createDataFrame(rows(3, 200), SCHEMA)
    assert content(statistics_against(both, current)) == content(D.drift_statistics(whole, current))


def test_empty_sides_and_missing_columns(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(rows(1, 50), SCHEMA)
    full, empty = write_profile(some, str(tmp_path / "full")), write_profile(none, str(tmp_path / "empty"))
    assert content(report_against(full, none, "d")) == content(D.drift_report(some, none, "d"))
    assert content(report_against(empty, some, "d")) == content(D.drift_report(none, some, "d"))
    assert [r.column for r in statistics_against(full, some.select("kind", "other")).collect()] == ["kind"]
    with pytest.raises(ValueError):
        statistics_against(full, some.select("other"))


def test_alerts_on_the_turn_only(spark):
    """Days arrive in any order and one is corrected; the flag is set on three days in a row and again later."""
    days = [("d3", True), ("d1", False), ("d2", True), ("d4", True), ("d5", None), ("d6", True), ("d7", False)]
    flags = [spark.createDataFrame([(d, on, d == "d1")], "date string, drift_detected boolean, model_drift_detected boolean") for d, on in days]
    history = D.flag_rows(*flags)
    assert sorted(tuple(r) for r in D.turned_on(history).collect()) == [
        ("d1", "model_drift_detected"), ("d2", "drift_detected"), ("d6", "drift_detected")]
    assert history.count() == 14 and D.turned_on(history.limit(0)).collect() == []
