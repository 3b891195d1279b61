import random

import pytest
from pyspark.sql import functions as F

from tideline.operators.upsert import ambiguous_matches, duplicate_keys, is_small, latest_per_key, upsert
from tideline.sources.tables import create_or_upsert, drop_table, overwrite_table, publish, scan_table
from tideline.operators.expectations import ExpectationFailed, rules
from tideline.operators.upsert import DuplicateKeys
from tideline.workspace import child_names

SCHEMA = "lon double, lat double, price double, name string"


def merge_by_hand(target, updates, columns):
    """Row by row: what MERGE does with update columns (positions) on key positions 0 and 1."""
    result, hit = [], set()
    for row in target:
        new = list(row)
        for i, update in enumerate(updates):
            if None not in row[:2] and row[:2] == update[:2]:
                hit.add(i)
                for c in columns:
                    new[c] = update[c]
        result.append(tuple(new))
    inserted = [u for i, u in enumerate(updates) if i not in hit]
    return result + [tuple(v if c in columns else None for c, v in enumerate(u)) for u in inserted]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_merging_by_hand(spark, rows, seed, small):
    rng = random.Random(seed)
    def key():
        return rng.choice([None, *map(float, range(6))]), rng.choice([None, 0.0, 1.0])
    target = [(*key(), rng.random(), "t") for _ in range(40)]
    distinct = {}
    for _ in range(12):
        k = key()
        distinct[k if None not in k else (k, rng.random())] = (*k, rng.random(), "u")
    updates = list(distinct.values())
    t, u = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(updates, SCHEMA)
    expected = sorted(merge_by_hand(target, updates, [0, 1, 2, 3]), key=repr)
    assert rows(upsert(t, u, ["lon", "lat"], small_updates=small)) == expected
    expected = sorted(merge_by_hand(target, updates, [0, 1, 2]), key=repr)
    assert rows(upsert(t, u.drop("name"), ["lon", "lat"], small_updates=small)) == expected


def test_unique_target_gives_the_same(spark, rows):
    t = spark.createDataFrame([(1.0, 1.0, 5.0, "a"), (2.0, 2.0, 6.0, "b"), (None, 1.0, 7.0, "n")], SCHEMA)
    u = spark.createDataFrame([(2.0, 2.0, 9.0, "B"), (3.0, 3.0, 8.0, "c"), (None, 1.0, 1.0, "m")], SCHEMA)
    keys = ["lon", "lat"]
    assert rows(upsert(t, u, keys, unique_target=True)) == rows(upsert(t, u, keys))
    assert upsert(t, u, keys).count() == 5


def test_newer_by_leaves_newer_target_rows(spark, rows):
    t = spark.createDataFrame([(1, 5, "new"), (2, 1, "old")], "k int, version int, v string")
    u = spark.createDataFrame([(1, 4, "late"), (2, 4, "fresh"), (3, 4, "first")], "k int, version int, v string")
    assert rows(upsert(t, u, ["k"], newer_by="version"), "k", "v") == [(1, "new"), (2, "fresh"), (3, "first")]


def test_unknown_update_column_is_refused(spark):
    with pytest.raises(ValueError):
        upsert(spark.range(1), spark.range(1).selectExpr("id", "1 AS more"), ["id"])


def test_duplicates_are_found_and_only_matches_are_ambiguous(spark, rows):
    t = spark.createDataFrame([(1, "t")], "k int, v string")
    u = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d"), (None, "e"), (None, "f")], "k int, v string")
    assert rows(duplicate_keys(u, ["k"])) == [(1, 2), (2, 2)]
    assert rows(ambiguous_matches(t, u, ["k"])) == [(1, 2)]


def test_latest_per_key_keeps_null_keys_and_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (None, 1, "x"), (None, 1, "x")], "k int, version int, v string"
    )
    assert rows(latest_per_key(df, ["k"], ["version"]), "k", "v") == [(1, "c"), (None, "x"), (None, "x")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS version", "'v' AS v")
    plan = latest_per_key(df, ["k"], ["version"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")


def test_small_updates_do_not_shuffle_the_target(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        target = spark.range(1000).selectExpr("id AS k", "'t' AS v")
        updates = spark.range(5).selectExpr("id AS k", "'u' AS v")
        plan = upsert(target, updates, ["k"], unique_target=True, small_updates=True)
        assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_is_small(spark):
    assert is_small(spark.range(5), 5) and not is_small(spark.range(6), 5)


def test_table_is_created_then_merged(spark, rows):
    name = "default.listing_copy"
    drop_table(spark, name)
    create_or_upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), name, ["k"])
    create_or_upsert(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), name, ["k"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c")]
    twice = spark.createDataFrame([(3, "x"), (3, "y")], "k int, v string")
    with pytest.raises(DuplicateKeys):
        create_or_upsert(twice, name, ["k"])
    new_twice = spark.createDataFrame([(9, "x"), (9, "y")], "k int, v string")
    create_or_upsert(new_twice, name, ["k"])
    assert spark.table(name).count() == 5
    assert scan_table(spark, name, 1.0).count() == 5
    assert scan_table(spark, name, 0.5, seed=3).count() <= 5


def test_publish_gate_keeps_the_old_table(spark, rows):
    name = "default.gated"
    drop_table(spark, name)
    gate = rules({"positive": "id > 0"}, action="fail")
    publish(spark.range(1, 3), name, gate)
    with pytest.raises(ExpectationFailed):
        publish(spark.range(0, 9), name, gate)
    assert rows(spark.table(name)) == [(1,), (2,)]
    warned = publish(spark.table(name).selectExpr("id - 1 AS id"), name, rules({"positive": "id > 0"}))
    assert warned == {"positive": 1}
    assert rows(spark.table(name)) == [(0,), (1,)]
    publish(spark.range(2).selectExpr("id", "'x' AS more"), name)
    assert spark.table(name).columns == ["id", "more"]


def test_replaced_folder_is_kept_unless_told(spark):
    name = "default.replaced"
    drop_table(spark, name)
    folders = []
    for i, keep in enumerate((True, True, False)):
        publish(spark.range(i), name, keep_previous=keep)
        folders.append(spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type)
    assert [bool(child_names(spark, f)) for f in folders] == [True, False, True]
    assert spark.table(name).count() == 2


def test_hot_target_key_is_split(spark):
    """With large updates, adaptive execution splits the target partition that holds a hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = "if(id % 3 = 0, 0, id) AS k"
        target = spark.range(0, 200000, 1, 8).selectExpr(hot, "md5(cast(id AS string)) AS v")
        updates = spark.range(0, 400000, 4, 4).selectExpr("id AS k", "'u' AS v")
        merged = upsert(target, updates, ["k"])
        found = {r.v: r.n for r in merged.groupBy(F.expr("if(v = 'u', 'u', 't') AS v")).agg(F.count("*").alias("n")).collect()}
        merged.write.format("noop").mode("overwrite").save()
        out = upsert(target, updates, ["k"])
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        # 66667 rows of key 0 and each untouched multiple of four are replaced; the rest of the updates are new.
        old = 200000 - 66667 - sum(1 for i in range(1, 200000) if i % 4 == 0 and i % 3)
        assert found["t"] == old
        present = sum(1 for i in range(0, 400000, 4) if i == 0 or (i < 200000 and i % 3))
        assert found["u"] == 200000 - old + 100000 - present
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_overwrite_table(spark):
    overwrite_table(spark.range(3), "default.plain")
    overwrite_table(spark.range(2), "default.plain")
    assert spark.table("default.plain").count() == 2


@pytest.mark.parametrize("newer_by", [None, "version"])
@pytest.mark.parametrize("fewer", [False, True])
def test_unique_target_is_merged_in_one_join(spark, rows, newer_by, fewer):
    target = spark.createDataFrame(
        [(i if i % 7 else None, f"old{i}", i % 5, None if i % 3 else "x") for i in range(60)], "k long, v string, version int, w string"
    )
    updates = spark.createDataFrame(
        [(i if i % 11 else None, f"new{i}", i % 4, "y") for i in range(30, 90)], "k long, v string, version int, w string"
    )
    updates = updates.drop("w") if fewer else updates
    general = upsert(target, updates, ["k"], newer_by=newer_by)
    one = upsert(target, updates, ["k"], newer_by=newer_by, unique_target=True)
    assert rows(one) == rows(general) and one.columns == target.columns
    assert rows(upsert(target, updates, ["k"], newer_by=newer_by, unique_target=True, small_updates=True)) == rows(general)
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "FullOuter" in plan
