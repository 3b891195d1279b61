import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.functions.hashing import hash_normal
from tideline.functions.statistics import chi2_p_value, erfc, ks_p_value, normal_tail
from tideline.operators import drift as D
from tideline.operators.skew import append_variants, blank_to_null, fit_johnson_su, skew_numeric

P_VALUES = D.DriftSettings(method="p-value")


def by_hand(reference, current):
    """KS and Wasserstein distance from the definitions."""
    points = sorted(set(reference) | set(current))
    r, c = Counter(reference), Counter(current)
    ks = wasserstein = f = g = 0.0
    for i, point in enumerate(points):
        f += r[point] / len(reference)
        g += c[point] / len(current)
        ks = max(ks, abs(f - g))
        if i + 1 < len(points):
            wasserstein += abs(f - g) * (points[i + 1] - point)
    return ks, wasserstein


def column(spark, values, name="x", kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_numeric_statistics_do_not_depend_on_the_buckets(spark, buckets, monkeypatch):
    monkeypatch.setattr(D, "LAYOUT_ROWS", 10**9)
    rng = random.Random(buckets)
    # A third of the reference is one value; the rest is spread, with values on one side only.
    reference = [5.0] * 300 + [round(rng.gauss(4, 3), 2) for _ in range(600)]
    current = [round(rng.expovariate(0.2), 1) for _ in range(500)] + [-1e9, 1e9]
    found = D.drift_statistics(
        column(spark, reference), column(spark, current), settings=D.DriftSettings(buckets=buckets)
    ).first()
    ks, wasserstein = by_hand(reference, current)
    assert found.ks == pytest.approx(ks, abs=1e-12)
    assert found.wasserstein == pytest.approx(wasserstein, rel=1e-9)
    mean = sum(reference) / len(reference)
    spread = math.sqrt(sum((v - mean) ** 2 for v in reference) / len(reference))
    assert found.wasserstein_normed == pytest.approx(wasserstein / spread, rel=1e-9)
    assert (found.reference_rows, found.current_rows) == (900, 502)


def test_values_are_laid_out_in_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(D, "LAYOUT_ROWS", 10**9)
    df = spark.range(1000).selectExpr("cast(id AS double) AS x")
    sizes = D.numeric_counts(df, df, ["x"], D.DriftSettings(buckets=10)).groupBy("bucket").count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 150


def test_counts_are_shuffled_once(spark):
    df = spark.range(1000).selectExpr("cast(id AS double) AS x")
    found = D.drift_statistics(df, df.selectExpr("x + 1 AS x"))
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_null_and_nan_are_left_out(spark):
    found = D.drift_statistics(column(spark, [1.0, 2.0, None, math.nan]), column(spark, [1.0, 2.0])).first()
    assert (found.reference_rows, found.ks, found.wasserstein) == (2, 0.0, 0.0)


def test_infinite_values_are_counted(spark):
    found = D.drift_statistics(column(spark, [1.0, 2.0, math.inf]), column(spark, [1.0, 2.0, 3.0])).first()
    assert found.reference_rows == 3 and found.ks == pytest.approx(1 / 3)


def test_identical_sides_and_constant_column(spark):
    same = column(spark, [3.0] * 20)
    report = D.drift_report(same, same, "2024-01-31", settings=P_VALUES).first()
    assert report.statistic == 1.0 and not report.drifted
    many = spark.range(2000).selectExpr("cast(id AS double) AS x", "cast(id % 3 AS string) AS s")
    assert {r.drifted for r in D.drift_report(many, many).collect()} == {False}
    assert {r.statistic for r in D.drift_report(many, many).collect()} == {0.0}


def test_categories_on_one_side_only(spark):
    reference = column(spark, ["a"] * 50 + ["b"] * 50, "s", "string")
    current = column(spark, ["a"] * 50 + ["c"] * 50, "s", "string")
    found = D.drift_statistics(reference, current).first()
    assert found.jensen_shannon == pytest.approx(math.sqrt(0.5 * math.log(2)))
    assert found.chi2 == pytest.approx(100.0)
    assert found.all_values == 3


def test_empty_current_side_has_drifted(spark):
    reference = spark.range(10).selectExpr("cast(id AS double) AS x", "cast(id AS string) AS s")
    report = D.drift_report(reference, reference.limit(0)).collect()
    assert {(r.statistic, r.drifted) for r in report} == {(None, True)}


@pytest.mark.parametrize(
    "values, method, by_distance",
    [
        (2, "z p-value", "jensen-shannon"),
        (4, "chi-square p-value", "jensen-shannon"),
        (50, "ks p-value", "wasserstein normed"),
    ],
)
@pytest.mark.parametrize("rows", [100, 2000])
def test_choice_of_method(spark, values, rows, method, by_distance):
    """The caller's choice, the same at every size."""
    df = spark.range(rows).selectExpr(f"cast(id % {values} AS double) AS x")
    assert D.drift_report(df, df, settings=P_VALUES).first().method == method
    assert D.drift_report(df, df).first().method == by_distance


def test_unknown_method_and_text_that_is_no_number(spark):
    df = column(spark, [1.0, 2.0])
    with pytest.raises(ValueError, match="method"):
        D.drift_report(df, df, settings=D.DriftSettings(method="guess"))
    text = df.select(F.when(F.col(df.columns[0]) > 1, "n/a").otherwise("1.0").alias(df.columns[0]))
    counts = D.numeric_counts(df, text, df.columns)
    assert sorted((r.value, r.r, r.c) for r in counts.collect()) == [(1.0, 1, 1), (2.0, 1, 0)]


def test_z_p_value_of_two_proportions(spark):
    reference = column(spark, ["a"] * 60 + ["b"] * 40, "s", "string")
    current = column(spark, ["a"] * 40 + ["b"] * 60, "s", "string")
    z = (0.6 - 0.4) / math.sqrt(0.5 * 0.5 * (1 / 100 + 1 / 100))
    report = D.drift_report(reference, current, settings=P_VALUES).first()
    assert report.statistic == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-12)
    assert report.threshold == 0.05 and report.drifted


def test_dataset_flag_and_alerts(spark, rows):
    report = spark.createDataFrame([("d", "a", True), ("d", "b", False)], "date string, column string, drifted boolean")
    flag = D.dataset_flag(report)
    assert rows(flag) == [("d", True)]
    assert flag.dtypes == [("date", "string"), ("drift_detected", "boolean")]
    strict = D.dataset_flag(report, "model_drift_detected", D.DriftSettings(drift_share=0.6))
    assert rows(strict) == [("d", False)]
    assert rows(D.alerts(flag, strict)) == [("d", "drift_detected")]


def test_excluded_and_unshared_columns(spark):
    reference = spark.createDataFrame([(1.0, "a", 2.0)], "x double, s string, price double")
    current = spark.createDataFrame([(1.0, "a", 3)], "x double, s string, other int")
    assert D.comparable_columns(reference, current, ["price"]) == (["x"], ["s"])
    with pytest.raises(ValueError):
        D.drift_statistics(reference.select("price"), current)


def test_target_drift_compares_the_prediction(spark):
    reference = spark.range(100).selectExpr("cast(id AS double) AS price")
    scored = spark.range(100).selectExpr("cast(id AS double) AS price", "cast(id + 90 AS double) AS prediction")
    assert D.target_drift_report(reference, scored, "price").first().drifted
    assert not D.target_drift_report(reference, scored, "price", "price").first().drifted


# --- tails: table values of the chi-square, normal and Kolmogorov distributions ---


@pytest.mark.parametrize(
    "x, dof, p, within",
    [
        (3.841458821, 1, 0.05, 1e-9),
        (5.991464547, 2, 0.05, 1e-9),
        (7.814727903, 3, 0.05, 1e-9),
        (18.307038053, 10, 0.05, 1e-9),
        (124.342113404, 100, 0.05, 1e-9),
        (1074.679449, 1000, 0.05, 1e-8),
        (0.0, 4, 1.0, 0),
        (2000.0, 3, 0.0, 1e-300),
        (10234.75, 10001, 0.05, 1e-3),
    ],
)
def test_chi2_tail(spark, x, dof, p, within):
    df = spark.createDataFrame([(x, dof)], "x double, dof long")
    assert df.select(F.expr(chi2_p_value("x", "dof"))).first()[0] == pytest.approx(p, abs=within)


def test_approximate_chi2_tail(spark):
    df = spark.createDataFrame([(1074.679449, 1000), (124.342113404, 100)], "x double, dof long")
    found = [r[0] for r in df.select(F.expr(chi2_p_value("x", "dof", approximate=True))).collect()]
    assert found == pytest.approx([0.05, 0.05], abs=1e-3)


def test_erfc_and_normal_tail(spark):
    df = spark.createDataFrame([(i / 8,) for i in range(60)], "y double")
    for r in df.select("y", F.expr(erfc("y")).alias("e"), F.expr(normal_tail("-y")).alias("n")).collect():
        assert r.e == pytest.approx(math.erfc(r.y), abs=1e-14)
        assert r.n == pytest.approx(1 - math.erfc(r.y / math.sqrt(2)) / 2, abs=1e-14)


def test_kolmogorov_tail(spark):
    # sqrt(n m / (n + m)) = 1 for n = m = 2, so the distance is the scaled one.
    df = spark.createDataFrame([(1.358, 2, 2), (1.628, 2, 2), (0.01, 2, 2)], "d double, n long, m long")
    found = [r[0] for r in df.select(F.expr(ks_p_value("d", "n", "m"))).collect()]
    assert found == [pytest.approx(0.05, abs=1e-4), pytest.approx(0.01, abs=1e-4), 1.0]


# --- skew and defects ---


def test_johnson_fit_recovers_its_parameters():
    gamma, delta, xi, scale = -0.7, 1.4, 10.0, 3.0
    quantiles = [xi + scale * math.sinh((k * 0.524 - gamma) / delta) for k in (-3, -1, 1, 3)]
    assert fit_johnson_su(quantiles) == pytest.approx((gamma, delta, xi, scale))
    assert fit_johnson_su([0.0, 0.0, 0.0, 0.0]) is None


def test_skewed_copy_is_repeatable_and_close_to_the_fit(spark, rows):
    draws = spark.range(4000).withColumn("z", hash_normal(["id"], "source"))
    df = draws.selectExpr("id", "10 + 3 * sinh((z + 0.7) / 1.4) AS x", "if(id = 7, NULL, 1D) AS c", "'s' AS s")
    skewed = skew_numeric(df, ["id"])
    again = skew_numeric(df.repartition(3), ["id"])
    assert rows(skewed.select("id", F.round("x", 9))) == rows(again.select("id", F.round("x", 9)))
    assert skewed.filter("c IS NULL").count() == 1 and skewed.filter("c = 1").count() == 3999
    assert skewed.dtypes == df.dtypes
    found = {r.column: r.ks for r in D.drift_statistics(df, skewed).collect()}
    assert 0 < found["x"] < 0.05


def test_defects_are_appended_and_nulled(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    out = append_variants(df, [(df, {"s": F.lit("unknown")}), (df.limit(1), {"s": F.lit(" ")})])
    assert rows(blank_to_null(out, ["s"])) == [(1, "a"), (1, "unknown"), (1, None), (2, "b"), (2, "unknown")]


def test_quantiles_are_exact_and_meet_in_no_task(spark):
    data = [float(i * 37 % 1001) for i in range(1001)] + [None, float("nan")]
    df = spark.createDataFrame([(v, None if i % 2 else 3.0) for i, v in enumerate(data)], "x double, y double").repartition(5)
    found = {r.column: r for r in D.numeric_quantiles(df, ["x", "y"], [0.25, 0.5, 1.0], D.DriftSettings(buckets=7)).collect()}
    assert (found["x"].n, found["x"].mean, found["x"].quantiles) == (1001, 500.0, [250.0, 500.0, 1000.0])
    assert found["x"].sd == pytest.approx(math.sqrt((1001**2 - 1) / 12))
    assert (found["y"].sd, found["y"].quantiles) == (0.0, [3.0, 3.0, 3.0])
    empty = df.limit(0)
    assert D.numeric_quantiles(empty, ["x"], [0.5]).collect() == []
    plan = D.numeric_quantiles(df, ["x"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "percentile" not in plan


def test_draws_of_the_query_are_written_once(spark):
    """The comparisons read the draws; none of them hashes the keys again."""
    from tideline.plans.queries import QUERIES

    found = QUERIES["skew_numeric"](spark, "/root/testdata/sf0.001")
    assert "md5" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.first().asDict() == {
        "all_rows": 6000, "unfinished_rows": 0, "lost_keys": 0, "close_to_the_columns": True, "columns_that_fire": 4
    }


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_distinct_values_are_sorted_where_their_one_shuffle_puts_them(spark, buckets):
    """No count of distinct values goes before the shuffle, and rows of one value on either side are still one value."""
    reference = [float(i % 4000) for i in range(4000)] + [7.0, 7.0, math.inf, -math.inf, -math.inf]
    current = [i + 0.5 for i in range(3990)] + [7.0, 7.0, 9.0, -math.inf]
    settings = D.DriftSettings(buckets=buckets)
    found = D.drift_statistics(column(spark, reference), column(spark, current), settings=settings)
    row = found.first()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [place" in plan and "Aggregate [place#" in plan
    assert not any("Aggregate [place" in line and "value#" in line.split("],")[0] for line in plan.splitlines())
    assert (row.reference_rows, row.current_rows) == (4005, 3994)
    assert (row.reference_values, row.all_values) == (4002, 4002 + 3990)
    finite = [v for v in reference if abs(v) < math.inf], [v for v in current if abs(v) < math.inf]
    row = D.drift_statistics(*(column(spark, v) for v in finite), settings=settings).first()
    assert (row.ks, row.wasserstein) == (pytest.approx(by_hand(*finite)[0], abs=1e-12), pytest.approx(by_hand(*finite)[1], rel=1e-9))
