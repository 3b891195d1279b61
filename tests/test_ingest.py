import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.listings import frame, listing, mock_rows
from tideline.functions.versions import file_version
from tideline.operators.expectations import ExpectationFailed, rules
from tideline.operators.upsert import DuplicateKeys
from tideline.plans.medallion import run_external, run_internal
from tideline.schemas import COMPOSITE, LINEAGE, LISTING_KEYS, LISTING_SCHEMA
from tideline.sources.files import (
    CORRUPT,
    VERSION,
    high_water_mark,
    scan_csv,
    versions_present,
    with_lineage,
)
from tideline.sources.ingest import (
    Feed,
    bronze,
    committed,
    compact,
    expire,
    ingest,
    land,
    last_version,
    refusals,
    table_folder,
)
from tideline.streaming.files import file_stream, stream_deliveries, stream_to_table

SCHEMA = T.StructType(
    [T.StructField("k", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("name", T.StringType())]
)


def deliver(folder, version, lines, header="k,price,name"):
    """A single file <folder>/listing_<version>.csv, moved into place when complete."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/listing_{version}.csv"
    with open(path + ".part", "w") as file:
        file.write("\n".join([header, *lines]) + "\n")
    os.rename(path + ".part", path)


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "table")


def feed(landing, **options):
    return Feed(landing, SCHEMA, ["k"], **options)


def test_version_is_a_number(spark):
    paths = ["dir/x_9.csv", "dir/x_10.csv", "dir/test_x_3.csv/part-0.csv", "dir/readme.txt", "s3://b/a_7.csvx", "z_4.csv.gz"]
    df = spark.createDataFrame([(p,) for p in paths], f"{LINEAGE} string")
    assert [r[0] for r in df.select(file_version(LINEAGE)).collect()] == [9, 10, 3, None, None, 4]
    assert high_water_mark(df).first().last_version == 10
    assert high_water_mark(df.limit(0)).first().last_version is None


def test_missing_first_file_fails(spark, place):
    landing, table = place
    os.makedirs(landing)
    with pytest.raises(FileNotFoundError):
        ingest(spark, feed(landing), table)


def test_later_versions_win_past_nine(spark, rows, place):
    landing, table = place
    for v in range(1, 12):
        deliver(landing, v, [f"0,{v}.5,hot", f"{v},1.0,own"])
    out = ingest(spark, feed(landing), table)
    assert out.count() == 12
    assert rows(out.filter("k = 0"), "price", VERSION) == [(11.5, 11)]
    assert last_version(spark, table) == 11
    assert land(spark, feed(landing), table) == []
    deliver(landing, 12, ["0,12.5,hot"])
    assert land(spark, feed(landing), table) == [12]
    assert rows(bronze(spark, feed(landing), table).filter("k = 0"), "price") == [(12.5,)]


def test_file_limit_takes_the_oldest_first(spark, rows, place):
    landing, table = place
    for v in (1, 2, 3):
        deliver(landing, v, [f"1,{v}.0,a"])
    assert land(spark, feed(landing), table, max_files=2) == [1, 2]
    assert rows(bronze(spark, feed(landing), table), "price") == [(2.0,)]
    assert land(spark, feed(landing), table, max_files=2) == [3]


def test_snapshot_changes_nothing_visible(spark, rows, place):
    landing, table = place
    f = feed(landing)
    for v in (1, 2):
        deliver(landing, v, [f"{v},1.0,a", f"9,{v}.0,b"])
    land(spark, f, table)
    before = rows(bronze(spark, f, table))
    compact(spark, f, table)
    compact(spark, f, table)
    assert committed(spark, table, "snapshots") == [1]
    assert rows(bronze(spark, f, table)) == before
    deliver(landing, 3, ["9,3.0,b"])
    land(spark, f, table)
    merged = rows(bronze(spark, f, table))
    compact(spark, f, table)
    expire(spark, table, keep=1)
    assert committed(spark, table, "snapshots") == [2] and committed(spark, table, "deliveries") == []
    assert rows(bronze(spark, f, table)) == merged and last_version(spark, table) == 3


def test_only_pending_files_are_read(spark, place):
    landing, _ = place
    for v in range(1, 6):
        deliver(landing, v, [f"{v},1.0,a"])
    df = with_lineage(scan_csv(spark, landing, SCHEMA)).filter(F.col(VERSION) > 4)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    assert plan.metrics().apply("numFiles").value() == 1


def test_uncommitted_folder_is_invisible_and_replaced(spark, rows, place):
    landing, table = place
    f = feed(landing)
    deliver(landing, 1, ["1,1.0,a"])
    land(spark, f, table)
    spark.range(3).write.parquet(f"{table}/deliveries/commit=2")
    deliver(landing, 2, ["1,2.0,a"])
    assert last_version(spark, table) == 1
    assert rows(bronze(spark, f, table), "price") == [(1.0,)]
    land(spark, f, table)
    assert rows(bronze(spark, f, table), "price") == [(2.0,)]


def test_duplicate_key_in_one_delivery(spark, rows, place):
    landing, table = place
    deliver(landing, 1, ["1,1.0,a", "1,2.0,a", ",3.0,n", ",3.0,n"])
    deliver(landing, 2, ["2,1.0,b", "2,5.0,b"])
    assert land(spark, feed(landing), table, max_files=1) == [1]
    with pytest.raises(DuplicateKeys):
        land(spark, feed(landing), table)
    assert last_version(spark, table) == 1
    assert bronze(spark, feed(landing), table).count() == 4
    resolving = feed(landing, on_duplicate="latest", order_by=("price",))
    land(spark, resolving, table)
    assert rows(bronze(spark, resolving, table).filter("k = 2"), "price") == [(5.0,)]


def test_first_delivery_keeps_duplicates_and_all_take_the_update(spark, rows, place):
    landing, table = place
    deliver(landing, 1, ["1,1.0,a", "1,2.0,a"])
    deliver(landing, 2, ["1,7.0,b"])
    assert rows(ingest(spark, feed(landing), table), "k", "price") == [(1, 7.0), (1, 7.0)]


def test_malformed_lines_are_kept_and_counted(spark, rows, place):
    landing, table = place
    deliver(landing, 1, ["1,1.0,a", "2,cheap,b"])
    out = ingest(spark, feed(landing), table)
    assert rows(out.filter(F.col(CORRUPT).isNotNull()), "k", "price", CORRUPT) == [(2, None, "2,cheap,b")]


def test_wrong_header_is_an_error(spark, place):
    landing, table = place
    deliver(landing, 1, ["a,1,1.0"], header="name,k,price")
    with pytest.raises(Exception, match="header"):
        ingest(spark, feed(landing), table).collect()


def test_strings_without_a_schema(spark, place):
    landing, _ = place
    deliver(landing, 1, ["1,1.0,a"])
    assert {t for _, t in scan_csv(spark, landing).dtypes} == {"string"}
    assert versions_present(spark, landing) == [1]


def test_internal_flow_on_mock_rows(spark):
    frame(spark, mock_rows()).write.mode("overwrite").saveAsTable("default.mock_listings")
    done = run_internal(spark, "default.mock_listings", namespace="default", test_mode=True)
    counts = done.row_counts(spark, {"bronze": 11, "silver": 1, "gold": 1})
    assert all(r.as_expected for r in counts.collect())
    assert spark.table(done.tables["gold"]).filter(F.col(COMPOSITE) == 7).count() == 1
    assert list(done.violations["bronze"].values()) == [10, 10, 0, 10]
    assert set(done.violations["gold"].values()) == {0}


def test_external_flow_on_two_files(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path)
    for version, offset in ((1, 0), (2, 50)):
        frame(spark, mock_rows(offset)).write.option("header", True).csv(f"{landing}/test_listing_{version}.csv")
    source = Feed(landing, LISTING_SCHEMA, LISTING_KEYS)
    assert ingest(spark, source, table_folder(root, "bronze", test_mode=True)).count() == 22
    merged = ingest(spark, source, table_folder(root, "bronze", test_mode=True), reset=True)
    assert merged.count() == 22
    done = run_external(spark, source, root, test_mode=True, namespace="default")
    counts = {r.layer: r.row_count for r in done.row_counts(spark).collect()}
    assert counts == {"bronze": 22, "silver": 2, "gold": 2}
    assert spark.table(done.tables["gold"]).filter(F.col(COMPOSITE) == 7).count() == 2
    assert CORRUPT not in spark.table(done.tables["gold"]).columns
    assert done.violations["bronze"]["line is well formed"] == 0
    again = run_external(spark, source, f"{root}/real", max_files=1, namespace="default")
    assert [r.row_count for r in again.row_counts(spark).orderBy("row_count").collect()] == [1, 1, 11]
    again = run_external(spark, source, f"{root}/real", namespace="default")
    assert spark.table(again.tables["bronze"]).count() == 22 and spark.table(again.tables["gold"]).count() == 2
    assert committed(spark, f"{root}/real/bronze", "snapshots") == [1, 2]
    assert run_external(spark, source, f"{root}/real", namespace="default").violations["bronze"] == {}


def test_stream_gives_what_batch_gives(spark, rows, place, tmp_path):
    landing, table = place
    f = feed(landing)
    for v in range(1, 12):
        deliver(landing, v, [f"0,{v}.5,hot", f"{v},1.0,own"])
    checkpoint = str(tmp_path / "checkpoint")
    stream_deliveries(spark, f, table, checkpoint, max_files=4).awaitTermination()
    assert len(committed(spark, table, "deliveries")) == 3
    batch = ingest(spark, f, str(tmp_path / "batch"))
    assert rows(bronze(spark, f, table)) == rows(batch)
    stream_deliveries(spark, f, table, checkpoint).awaitTermination()
    assert len(committed(spark, table, "deliveries")) == 3
    deliver(landing, 12, ["0,0.5,hot"])
    stream_deliveries(spark, f, table, checkpoint).awaitTermination()
    assert rows(bronze(spark, f, table).filter("k = 0"), "price") == [(0.5,)]


def test_late_version_in_a_stream_does_not_win_over_a_snapshot(spark, rows, place, tmp_path):
    landing, table = place
    f = feed(landing)
    checkpoint = str(tmp_path / "checkpoint")
    for v in (1, 3):
        deliver(landing, v, [f"1,{v}.0,a"])
    stream_deliveries(spark, f, table, checkpoint).awaitTermination()
    compact(spark, f, table)
    deliver(landing, 2, ["1,2.0,a", "5,2.0,e"])
    stream_deliveries(spark, f, table, checkpoint).awaitTermination()
    assert rows(bronze(spark, f, table), "k", "price") == [(1, 3.0), (5, 2.0)]


def test_stream_to_table_takes_each_file_once(spark, place, tmp_path):
    landing, _ = place
    checkpoint, path = str(tmp_path / "checkpoint"), str(tmp_path / "out")
    spark.sql("DROP TABLE IF EXISTS default.streamed")
    for v, expected in ((1, 1), (2, 2)):
        deliver(landing, v, [f"{v},1.0,a"])
        for _ in range(2):
            stream = file_stream(spark, landing, SCHEMA)
            stream_to_table(stream, "default.streamed", checkpoint, path).awaitTermination()
        assert spark.table("default.streamed").count() == expected


def test_listing_key_overwrites_equal_coordinates(spark, rows, tmp_path):
    landing = str(tmp_path / "landing")
    frame(spark, [listing(1)]).write.option("header", True).csv(f"{landing}/listing_1.csv")
    frame(spark, [listing(1, price=99.0)]).write.option("header", True).csv(f"{landing}/listing_2.csv")
    out = ingest(spark, Feed(landing, LISTING_SCHEMA, LISTING_KEYS), str(tmp_path / "table"))
    assert rows(out, "price", VERSION) == [(99.0, 2)]


def test_late_delivery_is_taken_and_does_not_win(spark, rows, place):
    landing, table = place
    for v in (1, 2, 4):
        deliver(landing, v, [f"9,{v}.0,hot", f"{v},1.0,own"])
    assert land(spark, feed(landing), table) == [1, 2, 4]
    for snapshot in (False, True):
        v = 5 if snapshot else 3
        if snapshot:
            compact(spark, feed(landing), table)
            deliver(landing, 6, ["9,6.0,hot"])
            assert land(spark, feed(landing), table) == [6]
        deliver(landing, v, [f"9,{v}.0,hot", f"{v},1.0,own"])
        assert land(spark, feed(landing), table) == [v]
    assert rows(bronze(spark, feed(landing), table), "k", "price") == [(1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0), (5, 1.0), (9, 6.0)]
    assert last_version(spark, table) == 6 and land(spark, feed(landing), table) == []


def test_later_file_of_a_taken_version(spark, rows, place):
    landing, table = place
    os.makedirs(f"{landing}/listing_1.csv")
    for part in ("a", "b"):
        with open(f"{landing}/listing_1.csv/{part} {part}%.csv", "w") as file:
            file.write(f"k,price,name\n{ord(part)},1.0,{part}\n")
        assert land(spark, feed(landing), table) == [1]
        assert land(spark, feed(landing), table) == []
    assert rows(bronze(spark, feed(landing), table), "k") == [(97,), (98,)]


def test_long_versions_and_names_without_one(spark, rows, place):
    landing, table = place
    deliver(landing, 20261201120000, ["1,1.0,a"])
    deliver(landing, 20261201120001, ["1,2.0,a"])
    assert rows(ingest(spark, feed(landing), table), "price", VERSION) == [(2.0, 20261201120001)]
    deliver(landing, "final", ["5,1.0,a"])
    with pytest.raises(ValueError, match="final"):
        land(spark, feed(landing), table)
    assert land(spark, feed(landing, on_unnamed="skip"), table) == []


def test_stream_and_batch_share_one_sequence(spark, rows, place, tmp_path):
    """Batch, snapshot, stream, new checkpoint, expiry: every file once, none lost."""
    landing, table = place
    f = feed(landing)
    for v in (1, 2, 3):
        deliver(landing, v, [f"{v},1.0,own", f"9,{v}.0,hot"])
    land(spark, f, table)
    compact(spark, f, table)
    for v, checkpoint in ((4, "one"), (5, "one"), (6, "two")):
        deliver(landing, v, [f"{v},1.0,own", f"9,{v}.0,hot"])
        stream_deliveries(spark, f, table, str(tmp_path / checkpoint)).awaitTermination()
        if v == 5:
            compact(spark, f, table)
            expire(spark, table, keep=1)
    assert land(spark, f, table) == []
    expected = [(1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0), (5, 1.0), (6, 1.0), (9, 6.0)]
    assert rows(bronze(spark, f, table), "k", "price") == expected
    assert last_version(spark, table) == 6


def test_repeated_key_after_expiry_is_refused(spark, place):
    landing, table = place
    f = feed(landing)
    deliver(landing, 1, ["1,1.0,a"])
    land(spark, f, table)
    compact(spark, f, table)
    expire(spark, table, keep=1)
    deliver(landing, 2, ["2,1.0,a", "2,2.0,b"])
    with pytest.raises(DuplicateKeys):
        land(spark, f, table)


def test_malformed_update_keeps_the_row(spark, rows, place):
    landing, table = place
    deliver(landing, 1, ["1,1.0,a", "2,1.0,b"])
    ingest(spark, feed(landing), table)
    deliver(landing, 2, ["1,n/a,a", "1,n/a,a"])
    out = ingest(spark, feed(landing), table)
    assert rows(out.filter(F.col(CORRUPT).isNull()), "k", "price") == [(1, 1.0), (2, 1.0)]
    assert out.filter(F.col(CORRUPT).isNotNull()).count() == 2


def test_a_stream_refuses_a_bad_file_and_goes_on(spark, rows, place, tmp_path):
    landing, table = place
    gate = rules({"price is positive": "price > 0"}, action="fail") + rules({"named": "name IS NOT NULL"})
    f = feed(landing, rules=gate)
    deliver(landing, 1, ["1,1.0,a", "2,2.0,"])
    deliver(landing, 2, ["1,-5.0,bad", "3,-3.0,bad"])
    deliver(landing, 3, ["3,3.0,c"])
    for _ in range(2):
        stream_deliveries(spark, f, table, str(tmp_path / "check"), max_files=1).awaitTermination()
        assert rows(bronze(spark, f, table), "k", "price") == [(1, 1.0), (2, 2.0), (3, 3.0)]
        found = refusals(spark, table).collect()
        assert [(r.version, r.violations) for r in found] == [(2, {"price is positive": 2})]
    with pytest.raises(ExpectationFailed):
        land(spark, f, table)
    assert rows(bronze(spark, f, table), "k", "price") == [(1, 1.0), (2, 2.0), (3, 3.0)]
    deliver(landing, 2, ["1,5.0,good"])
    assert land(spark, f, table) == [2]
    assert rows(bronze(spark, f, table), "k", "price") == [(1, 5.0), (2, 2.0), (3, 3.0)]
    assert refusals(spark, str(tmp_path / "none")).collect() == []
