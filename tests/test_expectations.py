import pytest
from pyspark.sql import functions as F

from tests.listings import frame, listing, mock_rows
from tideline.operators.expectations import (
    ExpectationFailed,
    check_observed,
    observed,
    require,
    row_count_verdicts,
    rules,
    violation_counts,
)
from tideline.plans.medallion import BRONZE_RULES, DEV_GOLD_RULES, GOLD_RULES
from tideline.sources.tables import publish_passing


def test_bronze_counts_under_both_readings_of_null(spark):
    bronze = frame(spark, mock_rows())
    counted = [r.violations for r in violation_counts(bronze, BRONZE_RULES).collect()]
    assert counted == [10, 10, 0, 10]
    counted = [r.violations for r in violation_counts(bronze, BRONZE_RULES, null_passes=True).collect()]
    assert counted == [10, 0, 0, 10]


def test_report_has_totals_and_verdicts(spark):
    report = violation_counts(frame(spark, mock_rows()), BRONZE_RULES)
    assert report.columns == ["rule", "action", "total_rows", "violations", "passed"]
    assert {(r.total_rows, r.action) for r in report.collect()} == {(11, "warn")}
    assert [r.passed for r in report.collect()] == [False, False, True, False]


def test_counting_is_one_pass(spark):
    plan = violation_counts(frame(spark, mock_rows()), GOLD_RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_fail_rule_raises_with_the_counts(spark):
    with pytest.raises(ExpectationFailed) as raised:
        require(frame(spark, mock_rows()), GOLD_RULES)
    assert raised.value.violations["cancellation_policy is not null"] == 10
    good = frame(spark, [listing(1)])
    assert require(good, GOLD_RULES) is good


def test_flag_rule(spark):
    with pytest.raises(ExpectationFailed) as raised:
        require(frame(spark, [listing(1, host_is_superhost="t")]), DEV_GOLD_RULES)
    assert raised.value.violations == {"host_is_superhost is a flag": 1}


def test_counts_ride_along_with_a_write(spark):
    watched, observation = observed(frame(spark, mock_rows()), BRONZE_RULES)
    watched.write.format("noop").mode("overwrite").save()
    assert list(check_observed(observation, BRONZE_RULES).values()) == [10, 10, 0, 10]
    strict = rules({"priced": "price > 1000"}, action="fail")
    watched, observation = observed(frame(spark, mock_rows()), strict)
    watched.write.format("noop").mode("overwrite").save()
    with pytest.raises(ExpectationFailed):
        check_observed(observation, strict)


def test_empty_frame_violates_nothing(spark):
    report = violation_counts(frame(spark, []), GOLD_RULES)
    assert {r.violations for r in report.collect()} == {0}


def test_row_count_verdicts(spark, rows):
    layers = {"bronze": spark.range(11), "silver": spark.range(1)}
    assert rows(row_count_verdicts(layers, {"bronze": 11, "silver": 2})) == [
        ("bronze", 11, True),
        ("silver", 1, False),
    ]
    assert row_count_verdicts(layers).filter(F.col("as_expected").isNull()).count() == 2


def test_refused_rows_are_kept_beside_the_table(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (-3, None), (-4, "b"), (5, "a")], "v int, t string")
    gate = [*rules({"positive": "v > 0", "named": "t IS NOT NULL"}, action="drop"), *rules({"small": "v < 5"})]
    violations, refused = publish_passing(df, "passing_rows", gate)
    assert violations == {"positive": 2, "named": 2, "small": 1}
    assert rows(spark.table("passing_rows")) == [(1, "a"), (5, "a")] and spark.table("passing_rows").columns == ["v", "t"]
    assert rows(refused) == [(-3, None, ["positive", "named"]), (-4, "b", ["positive"]), (2, None, ["named"])]
    with pytest.raises(ExpectationFailed):
        publish_passing(df, "passing_rows", rules({"large": "v > 3"}, action="fail"))
    assert spark.table("passing_rows").count() == 2
    for none, counts in ((df.filter("v < 0"), (0, 2)), (df.limit(0), (0, 0)), (df.filter("v = 1"), (1, 0))):
        _, refused = publish_passing(none, "passing_rows", gate)
        assert (spark.table("passing_rows").count(), refused.count()) == counts
    with pytest.raises(ValueError):
        publish_passing(df.withColumn("_refused", df.v), "passing_rows", gate)
