import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.listings import frame, listing, mock_rows
from tideline.functions.cleaning import columns_of_type, nullify
from tideline.functions.scoring import composite_score, register_composite_function
from tideline.operators.clean import distinct_rows, drop_blank, drop_incomplete, to_silver
from tideline.operators.columns import align_to, conform, last, overridden, predictions_as, without
from tideline.operators.gold import correct_score, to_gold
from tideline.schemas import COMPOSITE, LISTING_SCHEMA, REVIEW_SCORES, SCORING_SCHEMA, with_composite


def test_silver_keeps_the_good_row(spark):
    bronze = frame(spark, mock_rows())
    silver = to_silver(bronze)
    assert bronze.count() == 11 and silver.count() == 1
    gold = to_gold(silver, REVIEW_SCORES, COMPOSITE)
    assert gold.filter(F.col(COMPOSITE) == 7).count() == 1
    assert gold.schema[COMPOSITE].dataType == T.DoubleType()


def test_incomplete_means_null_or_nan(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 1.0), ("b", math.nan), ("c", None)], "s string, d double")
    assert [r.s for r in drop_incomplete(df).collect()] == ["a"]


def test_blank_is_empty_or_one_space_unless_trimmed(spark):
    df = spark.createDataFrame([("a",), ("",), (" ",), ("  ",)], "s string")
    assert sorted(r.s for r in drop_blank(df).collect()) == ["  ", "a"]
    assert [r.s for r in drop_blank(df, trim=True).collect()] == ["a"]


def test_blank_filter_without_string_columns_keeps_all(spark):
    assert drop_blank(spark.range(3)).count() == 3


def test_equal_rows_of_two_files_are_one_when_lineage_is_left_out(spark, rows):
    df = spark.createDataFrame([(1, "f_1"), (1, "f_2"), (2, "f_1")], "k int, file string")
    assert distinct_rows(df).count() == 3
    assert rows(distinct_rows(df, ["file"])) == [(1, "f_2"), (2, "f_1")]
    two = df.withColumn("version", F.lit(1))
    assert rows(distinct_rows(two, ["file", "version"])) == [(1, "f_2", 1), (2, "f_1", 1)]
    assert two.columns == distinct_rows(two, ["file", "version"]).columns


def test_blank_lineage_does_not_drop_the_row(spark):
    df = spark.createDataFrame([("a", " ")], "s string, file string")
    assert to_silver(df, lineage=["file"]).count() == 1


def test_nullify_takes_the_exact_sentinel(spark):
    df = spark.createDataFrame([(" ",), ("",), ("x",), (None,)], "s string")
    assert [r.s for r in df.select(nullify("s").alias("s")).collect()] == [None, "", "x", None]


def test_composite_of_text_null_and_malformed(spark):
    df = spark.createDataFrame([("1", 2.5), ("x", 1.0), (None, 1.0)], "a string, b double")
    assert [r.s for r in df.select(composite_score(["a", "b"]).alias("s")).collect()] == [3.5, None, None]


def test_composite_stays_in_the_jvm(spark):
    gold = to_gold(frame(spark, mock_rows()), REVIEW_SCORES, COMPOSITE)
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_score_correction_takes_the_part_out(spark):
    gold = to_gold(frame(spark, [listing(1, review_scores_rating=90.0)]), REVIEW_SCORES, COMPOSITE)
    assert gold.first()[COMPOSITE] == 102.0
    assert correct_score(gold, COMPOSITE, "review_scores_rating").first()[COMPOSITE] == 12.0
    as_text = gold.withColumn(COMPOSITE, F.col(COMPOSITE).cast("string"))
    assert correct_score(as_text, COMPOSITE, "review_scores_rating").first()[COMPOSITE] == 12.0
    assert correct_score(spark.range(1), COMPOSITE, "id").columns == ["id"]


def test_sql_function(spark):
    register_composite_function(spark, "total_of_three", 3)
    assert spark.sql("SELECT total_of_three(1, 2.5, 3) AS s").first().s == 6.5
    assert spark.sql("SELECT total_of_three(1, NULL, 3) AS s").first().s is None


def test_conform_projects_casts_and_drops_extras(spark):
    text = spark.createDataFrame([("12.5", "x", "extra")], "price string, accommodates string, note string")
    schema = T.StructType([LISTING_SCHEMA["accommodates"], LISTING_SCHEMA["price"]])
    done = conform(text, schema)
    assert done.schema.names == ["accommodates", "price"]
    assert tuple(done.first()) == (None, 12.5)


def test_scoring_schema_has_only_text_and_doubles():
    kinds = {f.name: f.dataType for f in SCORING_SCHEMA}
    assert len(kinds) == 25 and SCORING_SCHEMA.names[-2:] == [COMPOSITE, "price"]
    assert sum(t == T.StringType() for t in kinds.values()) == 7
    assert with_composite(LISTING_SCHEMA, T.StringType())[COMPOSITE].dataType == T.StringType()


def test_projections(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, price double, prediction double")
    assert last(df, "price").columns == ["id", "prediction", "price"]
    assert align_to(df, df.select("prediction", "id")).columns == ["prediction", "id"]
    assert without(df, ["price"]).columns == ["id", "prediction"]
    assert tuple(predictions_as(df, "price").first()) == (3.0,)
    assert columns_of_type(df, T.DoubleType, exclude=["price"]) == ["prediction"]
    assert tuple(overridden(df, {"id": F.lit(9)}).first()) == (9, 2.0, 3.0)


def test_union_widens_long_to_double(spark):
    whole = spark.createDataFrame([(1,)], "score long")
    parts = spark.createDataFrame([(0.5,)], "score double")
    assert whole.unionByName(parts).schema["score"].dataType == T.DoubleType()
