import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.test_ingest import deliver, feed
from tideline.operators.upsert import DuplicateKeys
from tideline.sources import buckets as B
from tideline.sources.buckets import BUCKET, BucketedTable, maintain_bronze
from tideline.sources.ingest import bronze, committed, land


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/{BUCKET}=*/*.parquet")}


def table(spark, tmp_path, n=400):
    kept = BucketedTable(str(tmp_path / "rows"), ["k", "j"], buckets=16)
    kept.create(spark.range(n).selectExpr("id AS k", "cast(id % 7 AS int) AS j", "id * 1.0 AS v", "'old' AS note"))
    return kept


def test_one_key_leaves_the_files_of_other_buckets(spark, tmp_path):
    kept = table(spark, tmp_path)
    before = files(kept.path)
    assert len(before) == 16
    hit = kept.merge(spark.createDataFrame([(8, 1, -1.0)], "k long, j int, v double"), 2)
    after = files(kept.path)
    assert len(hit) == 1
    untouched = {f: t for f, t in before.items() if f"{BUCKET}={hit[0]}/" not in f}
    assert len(untouched) == 15 and untouched.items() <= after.items()
    assert not {f for f in before if f not in untouched} & set(after)
    rows = {r.k: (r.v, r.note) for r in kept.read(spark).collect()}
    assert len(rows) == 400 and rows[8] == (-1.0, "old") and rows[9] == (9.0, "old")


def test_merge_reads_only_the_buckets_hit(spark, tmp_path, capfd):
    kept = table(spark, tmp_path)
    pruned = spark.read.parquet(kept.path).filter(F.col(BUCKET).isin([3, 5]))
    assert len(pruned.inputFiles()) == 16  # the listing; the scan below prunes it
    pruned.explain()
    assert f"PartitionFilters: [{BUCKET}#" in capfd.readouterr().out


def test_null_keys_and_repeated_merges(spark, tmp_path):
    kept = table(spark, tmp_path, 10)
    updates = spark.createDataFrame([(None, 1, 5.0, "a"), (None, 1, 5.0, "a"), (3, 3, 7.0, "new"), (99, None, 1.0, "b"), (50, 1, 2.0, "in")], "k long, j int, v double, note string")
    for _ in range(2):
        assert set(kept.merge(updates, 2)) >= {-2}
        rows = sorted((tuple(r) for r in kept.read(spark).collect()), key=repr)
        assert len(rows) == 14 and rows.count((None, 1, 5.0, "a")) == 2 and (3, 3, 7.0, "new") in rows
    kept.merge(updates.filter("k IS NULL"), 3)
    assert kept.read(spark).count() == 16
    assert kept.merge(updates.limit(0), 4) == []
    with pytest.raises(ValueError):
        kept.merge(updates, 1)


def test_ambiguous_updates_are_refused_before_a_write(spark, tmp_path):
    kept = table(spark, tmp_path, 10)
    before = files(kept.path)
    with pytest.raises(DuplicateKeys):
        kept.merge(spark.createDataFrame([(3, 3, 1.0), (3, 3, 2.0)], "k long, j int, v double"), 2)
    assert files(kept.path) == before


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bronze_in_buckets_equals_bronze(spark, tmp_path, monkeypatch):
    """Late deliveries, malformed lines, null keys, a run that dies before its marker, and a run with nothing new."""
    landing, folder = str(tmp_path / "landing"), str(tmp_path / "table")
    f = feed(landing)
    deliver(landing, 1, ["1,1.0,a", "1,2.0,again", "2,2.0,b", ",3.0,none", "x,4.0,bad"])
    land(spark, f, folder)
    assert content(maintain_bronze(spark, f, folder, 4)) == content(bronze(spark, f, folder))
    deliver(landing, 5, ["2,50.0,b5", "3,3.0,c", ",1.0,none", "4,oops,bad"])
    deliver(landing, 6, ["3,6.0,c6"])
    land(spark, f, folder)
    marker = B.commit_marker

    def dies(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(B, "commit_marker", dies)
    with pytest.raises(RuntimeError):
        maintain_bronze(spark, f, folder, 4)
    monkeypatch.setattr(B, "commit_marker", marker)
    expected = content(bronze(spark, f, folder))
    assert content(maintain_bronze(spark, f, folder, 4)) == expected
    before = files(f"{folder}/bucketed/rows")
    assert content(maintain_bronze(spark, f, folder, 4)) == expected and files(f"{folder}/bucketed/rows") == before
    deliver(landing, 4, ["2,40.0,late", "7,7.0,new"])
    land(spark, f, folder)
    assert content(maintain_bronze(spark, f, folder, 4)) == content(bronze(spark, f, folder))
    assert len(committed(spark, folder, "bucketed")) == 3
    rows = {r.k: r.price for r in maintain_bronze(spark, f, folder, 4).collect() if r.k in (2, 7)}
    assert rows == {2: 50.0, 7: 7.0}


def test_before_the_first_delivery(spark, tmp_path):
    assert maintain_bronze(spark, feed(str(tmp_path)), str(tmp_path / "table")).collect() == []
