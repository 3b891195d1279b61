"""Every operator as a query over the driver's tables. Each reads its tables whole."""

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tideline.functions.scoring import register_composite_function
from tideline.functions.versions import file_version
from tideline.operators import drift as D
from tideline.operators.clean import distinct_rows, drop_blank, drop_incomplete, to_silver
from tideline.operators.columns import conform, predictions_as
from tideline.operators.expectations import ExpectationFailed, row_count_verdicts, rules, violation_counts
from tideline.operators.gold import correct_score, to_gold
from tideline.operators.metrics import rmse, target_profile
from tideline.operators.model import FOREST_SPACE, feature_importance, indexer, score, train, tune
from tideline.operators.profile import add_to_profile, report_against, write_profile
from tideline.operators.runs import latest_model, newest_per_group
from tideline.operators.sampling import bernoulli_sample, hash_sample, hash_split, random_split, with_split
from tideline.operators.skew import append_variants, blank_to_null, skew_numeric
from tideline.operators.unseen import scorable_rows, unscorable_rows, unseen_by_category, unseen_rows
from tideline.operators.upsert import ambiguous_matches, is_small, latest_per_key, upsert
from tideline.plans.daily import DailyTables, monitor, score_daily
from tideline.plans.maintained import maintain_layers
from tideline.plans.medallion import Layers, layers, publish_layers, run_external, run_internal
from tideline.schemas import LINEAGE
from tideline.sources.buckets import BucketedTable, maintain_bronze
from tideline.sources.files import CORRUPT, VERSION, high_water_mark, scan_csv, with_lineage
from tideline.sources.ingest import Feed, bronze, compact, expire, land
from tideline.sources.tables import create_or_upsert, publish, publish_passing
from tideline.streaming.evolving import read_evolving, stream_evolving
from tideline.streaming.files import file_stream, stream_deliveries, stream_to_table
from tideline.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2024-01-31"
SPLIT = {"train": 0.6, "validation": 0.2, "test": 0.2}
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DELIVERY_PATTERN = r"delivery=([0-9]+)/"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- inputs with defects ---------------------------------------------------------------------------


def _is(priority: str, status: str) -> Column:
    return (F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") == status)


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with null, blank, empty and NaN values; urgent orders are delivered twice."""
    broken = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(_is("5-LOW", "F"), F.lit(None))
        .when(_is("4-NOT SPECIFIED", "O"), " ")
        .when(_is("3-MEDIUM", "P"), "")
        .otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        F.when(_is("2-HIGH", "F"), float("nan")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderpriority",
    )
    return broken.unionByName(broken.filter("o_orderpriority = '1-URGENT'"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


# --- cleaning, scoring, conforming -----------------------------------------------------------------


def silver_clean(spark, sf_dir):
    return to_silver(dirty_orders(spark, sf_dir))


def drop_incomplete_rows(spark, sf_dir):
    return drop_incomplete(dirty_orders(spark, sf_dir))


def drop_blank_rows(spark, sf_dir):
    return drop_blank(dirty_orders(spark, sf_dir)).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def distinct_without_lineage(spark, sf_dir):
    """Copies from two deliveries are one row; the lineage kept is the latest."""
    rows = _order_rows(spark, sf_dir)
    again = rows.filter("o_orderpriority = '1-URGENT'")
    both = rows.withColumn("delivery", F.lit(1)).unionByName(again.withColumn("delivery", F.lit(2)))
    return distinct_rows(both, ["delivery"])


def nullify_blank(spark, sf_dir):
    fixed = blank_to_null(dirty_orders(spark, sf_dir), ["o_orderstatus"])
    return fixed.select("o_orderkey", "o_orderstatus", "o_orderpriority")


def gold_composite_score(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(*LINE_KEYS, *MEASURES)
    return to_gold(lines, MEASURES, "composite", target="l_extendedprice")


def gold_score_correction(spark, sf_dir):
    gold = gold_composite_score(spark, sf_dir)
    return correct_score(gold, "composite", "l_extendedprice").select(*LINE_KEYS, "composite")


def sql_composite_function(spark, sf_dir):
    register_composite_function(spark, "composite_of_four", 4)
    lines = _lines(spark, sf_dir)
    return lines.select(*LINE_KEYS, F.expr(f"composite_of_four({', '.join(MEASURES)})").alias("composite"))


def conform_schema(spark, sf_dir):
    text = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(_is("2-HIGH", "F"), "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderstatus",
        "o_orderpriority",
    )
    wanted = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.DoubleType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    return conform(text, wanted)


# --- expectations ----------------------------------------------------------------------------------

_ORDER_PREDICATES = {
    "status is not null": "o_orderstatus IS NOT NULL",
    "status is not blank": "o_orderstatus != ' '",
    "status is not empty": "o_orderstatus != ''",
    "status is known": "o_orderstatus IN ('F', 'O', 'P')",
}


def expect_warn_counts(spark, sf_dir):
    return violation_counts(dirty_orders(spark, sf_dir), rules(_ORDER_PREDICATES))


def expect_null_passes(spark, sf_dir):
    return violation_counts(dirty_orders(spark, sf_dir), rules(_ORDER_PREDICATES), null_passes=True)


def expect_fail_gate(spark, sf_dir):
    gate = rules(_ORDER_PREDICATES, action="fail")
    dirty = dirty_orders(spark, sf_dir)
    verdicts = [
        violation_counts(df, gate).withColumn("dataset", F.lit(name))
        for name, df in (("bronze", dirty), ("silver", to_silver(dirty)))
    ]
    return verdicts[0].unionByName(verdicts[1])


def _order_layers(spark, sf_dir):
    return layers(dirty_orders(spark, sf_dir), Layers(["o_totalprice", "o_custkey"], "composite", "o_totalprice"))


def layer_row_counts(spark, sf_dir):
    return row_count_verdicts(_order_layers(spark, sf_dir)).drop("as_expected")


def medallion_flagship(spark, sf_dir):
    """Bronze with defects to silver to gold."""
    return _order_layers(spark, sf_dir)["gold"]


def medallion_tables(spark, sf_dir):
    """The same layers as published tables behind their rules, with their counts."""
    settings = Layers(
        ["o_totalprice", "o_custkey"],
        "composite",
        "o_totalprice",
        bronze_rules=rules(_ORDER_PREDICATES),
        gold_rules=rules(_ORDER_PREDICATES, action="fail"),
    )
    namespace = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{new_folder(spark, namespace)}'")
    done = publish_layers(dirty_orders(spark, sf_dir), settings, namespace)
    return done.row_counts(spark).drop("as_expected")


def layer_row_verdicts(spark, sf_dir):
    """Every layer is expected to hold as many rows as bronze: only bronze does."""
    made = _order_layers(spark, sf_dir)
    return row_count_verdicts(made, dict.fromkeys(made, made["bronze"].count()))


def _namespace(spark) -> str:
    namespace = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{new_folder(spark, namespace)}'")
    return namespace


def rejected_publish(spark, sf_dir):
    """A good table is published, then a dirty one that its gate refuses: the violations, and the rows still there."""
    name = f"{_namespace(spark)}.gold"
    gate = rules(_ORDER_PREDICATES, action="fail")
    dirty = dirty_orders(spark, sf_dir)
    publish(to_silver(dirty), name, gate)
    try:
        publish(dirty, name, gate)
        violations = {}
    except ExpectationFailed as refused:
        violations = refused.violations
    found = spark.createDataFrame(list(violations.items()), "rule string, violations long")
    return found.crossJoin(spark.table(name).agg(F.count(F.lit(1)).alias("rows_kept")))


def refused_rows(spark, sf_dir):
    """Orders behind rules that drop: the published rows, and the refused ones with the rules they violate."""
    name = f"{_namespace(spark)}.orders"
    _, refused = publish_passing(dirty_orders(spark, sf_dir), name, rules(_ORDER_PREDICATES, action="drop"))
    named = refused.withColumn("violated", F.concat_ws(",", "_violated")).drop("_violated")
    return spark.table(name).withColumn("violated", F.lit("")).unionByName(named)


_ORDER_SETTINGS = Layers(["o_totalprice", "o_custkey"], "composite", "o_totalprice", bronze_rules=[], gold_rules=[])


def internal_run(spark, sf_dir):
    """The whole flow over a catalog table, in test mode."""
    namespace = _namespace(spark)
    publish(dirty_orders(spark, sf_dir), f"{namespace}.source")
    done = run_internal(spark, f"{namespace}.source", settings=_ORDER_SETTINGS, namespace=namespace, test_mode=True)
    return done.row_counts(spark).drop("as_expected")


def external_run(spark, sf_dir):
    """The whole flow over versioned files: two runs, the second with nothing but new files, then one with none."""
    feed, namespace = _order_feed(_landed_orders(spark, sf_dir)), _namespace(spark)
    settings = replace(_ORDER_SETTINGS, lineage=(VERSION, LINEAGE))
    root = new_folder(spark, "external")
    for limit in (8, None, None):
        done = run_external(spark, feed, root, settings=settings, namespace=namespace, max_files=limit)
    return done.row_counts(spark).drop("as_expected")


# --- upsert ----------------------------------------------------------------------------------------


def _repriced(orders: DataFrame) -> DataFrame:
    """Urgent orders at a new price, without their priority; finished ones also under a new customer."""
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 100).alias("o_totalprice"), "o_orderstatus"
    )
    moved = urgent.filter("o_orderstatus = 'F'").withColumn("o_custkey", F.col("o_custkey") + 1_000_000_000)
    return urgent.unionByName(moved)


def upsert_composite_key(spark, sf_dir):
    orders = _order_rows(spark, sf_dir)
    return upsert(orders, _repriced(orders), ["o_orderkey", "o_custkey"])


def upsert_unique_target(spark, sf_dir):
    orders = _order_rows(spark, sf_dir).drop("o_orderpriority")
    updates = _repriced(_order_rows(spark, sf_dir))
    return upsert(orders, updates, ["o_orderkey", "o_custkey"], unique_target=True)


def upsert_null_keys(spark, sf_dir):
    """Low-priority orders have no customer on either side: they neither match nor collapse."""
    customer = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    orders = _order_rows(spark, sf_dir).withColumn("o_custkey", customer)
    updates = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 100)
    return upsert(orders, updates, ["o_orderkey", "o_custkey"])


def upsert_hot_target_key(spark, sf_dir):
    """Two fifths of the target rows share one key; every one of them takes the update."""
    hot = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(0)).otherwise(F.col("o_custkey"))
    orders = _order_rows(spark, sf_dir).withColumn("o_custkey", hot.cast("long"))
    updates = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("o_totalprice")
    )
    return upsert(orders, updates, ["o_custkey"])


def upsert_ambiguous_matches(spark, sf_dir):
    orders = _order_rows(spark, sf_dir)
    updates = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    return ambiguous_matches(orders, updates, ["o_orderkey"])


def _events(spark, sf_dir):
    return _table(spark, sf_dir, "events")


def upsert_latest_wins(spark, sf_dir):
    events = _events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id", "value")
    return latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


_MIDDLE = "ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"


def create_or_upsert_table(spark, sf_dir):
    """The first half of the month creates the table, the second is merged into it."""
    events = _events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id", "value")
    name = f"default.current_events_{uuid.uuid4().hex}"
    keys = ["user_id", "event_type"]
    for half in (events.filter(_MIDDLE), events.filter(f"NOT ({_MIDDLE})")):
        create_or_upsert(latest_per_key(half, keys, ["ts", "event_id"]), name, keys)
    return spark.table(name).drop("ts")


# --- files and streams -----------------------------------------------------------------------------

_ORDER_FILE = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


def _landed_orders(spark, sf_dir, price: Column | None = None) -> str:
    """One delivery per order year, then urgent orders of each year again at a new price: versions 1 to 14."""
    orders = _table(spark, sf_dir, "orders").select(
        *_ORDER_FILE.names, (F.year("o_orderdate") - 1994).alias("delivery")
    )
    again = orders.filter("o_orderpriority = '1-URGENT'").withColumns(
        {
            "delivery": F.col("delivery") + 7,
            "o_totalprice": F.col("o_totalprice") + 100 if price is None else price,
        }
    )
    folder = new_folder(spark, "landing")
    orders.unionByName(again).write.partitionBy("delivery").option("header", True).csv(folder)
    return folder


def _order_feed(folder: str) -> Feed:
    return Feed(folder, _ORDER_FILE, ["o_orderkey", "o_custkey"], DELIVERY_PATTERN)


def incremental_ingest(spark, sf_dir):
    """Three runs: five deliveries, then four more onto a snapshot, then the rest."""
    feed = _order_feed(_landed_orders(spark, sf_dir))
    table = new_folder(spark, "bronze")
    land(spark, feed, table, max_files=5)
    compact(spark, feed, table)
    land(spark, feed, table, max_files=4)
    land(spark, feed, table)
    return bronze(spark, feed, table).select(*_ORDER_FILE.names, VERSION)


def bucketed_ingest(spark, sf_dir):
    """The same deliveries in three runs, each merged into the key buckets it hits."""
    feed = _order_feed(_landed_orders(spark, sf_dir))
    table = new_folder(spark, "bronze")
    for files in (5, 4, None):
        land(spark, feed, table, max_files=files)
        kept = maintain_bronze(spark, feed, table, buckets=16)
    return kept.select(*_ORDER_FILE.names, VERSION)


def maintained_gold(spark, sf_dir):
    """Gold kept up over three runs of deliveries, some of which take the price away from rows that were in it."""
    price = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice") + 100)
    feed = _order_feed(_landed_orders(spark, sf_dir, price))
    table, settings = new_folder(spark, "maintained"), replace(_ORDER_SETTINGS, lineage=(VERSION, LINEAGE))
    for files in (8, 3, None):
        land(spark, feed, table, max_files=files)
        made = maintain_layers(spark, feed, table, settings, buckets=16)
    return made["gold"].drop(LINEAGE)


def bucketed_merge(spark, sf_dir):
    """A table of orders in key buckets, repriced ones and new keys merged in."""
    orders = _order_rows(spark, sf_dir)
    kept = BucketedTable(new_folder(spark, "orders"), ["o_orderkey", "o_custkey"], buckets=16)
    kept.create(orders)
    kept.merge(_repriced(orders), 2)
    return kept.read(spark)


def _deliver(landed: str, landing: str, spark: SparkSession, where: str) -> None:
    """Lands the chosen deliveries of another folder, which then are all there is of them."""
    lines = spark.read.option("basePath", landed).option("header", True).schema(_ORDER_FILE).csv(landed)
    lines.filter(where).write.mode("append").partitionBy("delivery").option("header", True).csv(landing)


def _in_turns(spark, sf_dir, turns) -> DataFrame:
    """Bronze after the given turns: (condition on the deliveries that arrive, what is run then)."""
    landed, landing = _landed_orders(spark, sf_dir), new_folder(spark, "landing")
    feed, table = _order_feed(landing), new_folder(spark, "bronze")
    for where, run in turns:
        _deliver(landed, landing, spark, where)
        run(feed, table)
    return bronze(spark, feed, table).select(*_ORDER_FILE.names, VERSION)


def ingest_late_delivery(spark, sf_dir):
    """Deliveries 3 and 9 arrive after later ones, the second after a snapshot; nothing is lost, nothing old wins."""

    def lands(feed, table):
        land(spark, feed, table)

    def lands_and_compacts(feed, table):
        land(spark, feed, table)
        compact(spark, feed, table)

    return _in_turns(
        spark,
        sf_dir,
        [
            ("delivery IN (1, 2, 4)", lands),
            ("delivery IN (3, 5, 6, 7, 8, 10)", lands_and_compacts),
            ("delivery IN (9, 11, 12, 13, 14)", lands),
        ],
    )


def ingest_long_versions(spark, sf_dir):
    """Versions as timestamps, beyond 32 bits."""
    landed, landing = _landed_orders(spark, sf_dir), new_folder(spark, "landing")
    lines = spark.read.option("basePath", landed).option("header", True).schema(_ORDER_FILE).csv(landed)
    stamped = lines.withColumn("delivery", F.col("delivery").cast("long") + 20_240_000_000_000)
    stamped.write.partitionBy("delivery").option("header", True).csv(landing)
    feed, table = _order_feed(landing), new_folder(spark, "bronze")
    land(spark, feed, table)
    return bronze(spark, feed, table).select(*_ORDER_FILE.names, VERSION)


def _streams(spark, checkpoint: str):
    return lambda feed, table: stream_deliveries(spark, feed, table, checkpoint).awaitTermination()


def stream_after_snapshot(spark, sf_dir):
    """Batch runs and a snapshot first, the rest as a stream into the same table."""

    def lands_and_compacts(feed, table):
        land(spark, feed, table, max_files=3)
        land(spark, feed, table)
        compact(spark, feed, table)

    stream = _streams(spark, new_folder(spark, "checkpoint"))
    turns = [("delivery <= 6", lands_and_compacts), ("delivery BETWEEN 7 AND 9", stream), ("delivery > 9", stream)]
    return _in_turns(spark, sf_dir, turns)


def stream_refused_batch(spark, sf_dir):
    """Three turns of a stream behind a rule: every second delivery of new prices has negative ones and is refused."""
    price = F.when(F.col("delivery") % 2 == 0, -1.0).otherwise(F.col("o_totalprice") + 100)
    landed, landing = _landed_orders(spark, sf_dir, price), new_folder(spark, "landing")
    gate = rules({"price is positive": "o_totalprice > 0"}, action="fail")
    feed, table = replace(_order_feed(landing), rules=gate), new_folder(spark, "bronze")
    checkpoint = new_folder(spark, "checkpoint")
    for where in ("delivery <= 7", "delivery > 7 AND delivery % 2 = 1", "delivery > 7 AND delivery % 2 = 0"):
        _deliver(landed, landing, spark, where)
        stream_deliveries(spark, feed, table, checkpoint).awaitTermination()
    return bronze(spark, feed, table).select(*_ORDER_FILE.names, VERSION)


def stream_new_checkpoint(spark, sf_dir):
    """A stream that starts over under a new checkpoint after a snapshot and an expiry: files it knows are passed over."""

    def starts_over(feed, table):
        compact(spark, feed, table)
        expire(spark, table, keep=1)
        _streams(spark, new_folder(spark, "checkpoint"))(feed, table)

    first = _streams(spark, new_folder(spark, "checkpoint"))
    return _in_turns(spark, sf_dir, [("delivery <= 7", first), ("delivery > 7", starts_over)])


def malformed_update_keeps_row(spark, sf_dir):
    """High-priority orders are delivered again with a price that is no number: the good rows stay."""
    folder = new_folder(spark, "landing")
    orders = _table(spark, sf_dir, "orders").select(*_ORDER_FILE.names)
    broken = orders.filter("o_orderpriority = '2-HIGH'").withColumn("o_totalprice", F.lit("n/a"))
    text = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")).withColumn("delivery", F.lit(1))
    both = text.unionByName(broken.withColumn("delivery", F.lit(2)))
    both.write.partitionBy("delivery").option("header", True).csv(folder)
    feed, table = _order_feed(folder), new_folder(spark, "bronze")
    land(spark, feed, table, max_files=1)
    land(spark, feed, table)
    return bronze(spark, feed, table).select(*_ORDER_FILE.names, F.col(CORRUPT).isNotNull().alias("malformed"))


def distinct_latest_lineage(spark, sf_dir):
    """Copies from files 9 and 10: the tenth is the later one, though not as text."""
    rows = _order_rows(spark, sf_dir)
    again = rows.filter("o_orderpriority = '1-URGENT'")

    def from_file(df: DataFrame, n: int) -> DataFrame:
        return df.withColumns({"file": F.lit(f"orders_{n}.csv"), VERSION: file_version(F.lit(f"orders_{n}.csv"))})

    return distinct_rows(from_file(rows, 9).unionByName(from_file(again, 10)), [VERSION, "file"])


def stream_upsert(spark, sf_dir):
    feed = _order_feed(_landed_orders(spark, sf_dir))
    table = new_folder(spark, "bronze")
    stream_deliveries(spark, feed, table, new_folder(spark, "checkpoint")).awaitTermination()
    return bronze(spark, feed, table).select(*_ORDER_FILE.names, VERSION)


def stream_to_parquet(spark, sf_dir):
    folder = _landed_orders(spark, sf_dir)
    name = f"default.landed_orders_{uuid.uuid4().hex}"
    stream = file_stream(spark, folder, _ORDER_FILE, pattern=DELIVERY_PATTERN).drop(CORRUPT)
    stream_to_table(stream, name, new_folder(spark, "checkpoint"), new_folder(spark, "table")).awaitTermination()
    return spark.table(name).select(*_ORDER_FILE.names, VERSION)


def stream_evolving_schema(spark, sf_dir):
    """Two deliveries as a stream: the second has one more column, and prices that are no numbers."""
    orders, landing, work = _table(spark, sf_dir, "orders"), new_folder(spark, "landing"), new_folder(spark, "evolving")
    late = orders.filter("o_orderstatus != 'F'").select(*_ORDER_FILE.names, "o_orderstatus")
    price = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_totalprice").cast("string"))
    turns = [orders.filter("o_orderstatus = 'F'").select(*_ORDER_FILE.names), late.withColumn("o_totalprice", price)]
    for number, rows in enumerate(turns, 1):
        rows.write.option("header", True).csv(f"{landing}/delivery={number}")
        places = f"{work}/rows", f"{work}/checkpoint"
        stream_evolving(spark, landing, _ORDER_FILE, *places, pattern=DELIVERY_PATTERN).awaitTermination()
    return read_evolving(spark, *places, _ORDER_FILE).drop(LINEAGE)


def csv_scan_malformed(spark, sf_dir):
    folder = new_folder(spark, "malformed")
    _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(_is("2-HIGH", "F"), "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderpriority",
    ).write.option("header", True).csv(folder)
    scanned = scan_csv(spark, folder, _ORDER_FILE)
    return scanned.select(*_ORDER_FILE.names, F.col(CORRUPT).isNotNull().alias("malformed"))


def csv_scan_strings(spark, sf_dir):
    folder = _landed_orders(spark, sf_dir)
    scanned = with_lineage(scan_csv(spark, folder), DELIVERY_PATTERN)
    return scanned.groupBy("o_orderpriority", VERSION).agg(F.count(F.lit(1)).alias("row_count"))


def ingest_high_water_mark(spark, sf_dir):
    paths = _events(spark, sf_dir).select(
        F.concat(F.lit("landing/events_"), F.dayofmonth("ts"), F.lit(".csv")).alias("input_file_name")
    )
    return high_water_mark(paths)


# --- samples and splits ----------------------------------------------------------------------------


def hash_split_labels(spark, sf_dir):
    return with_split(_events(spark, sf_dir).select("event_id"), ["event_id"], SPLIT)


def hash_sample_rows(spark, sf_dir):
    return hash_sample(_events(spark, sf_dir).select("event_id", "event_type", "value"), ["event_id"], 0.1)


def random_split_counts(spark, sf_dir):
    """The parts hold every row once, and each about its share."""
    events = _events(spark, sf_dir).select("event_id")
    parts = random_split(events, list(SPLIT.values()), seed=42)
    named = reduce(
        DataFrame.unionByName, [df.withColumn("part", F.lit(name)) for name, df in zip(SPLIT, parts, strict=True)]
    )
    counted = named.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.create_map(*(F.lit(x) for pair in SPLIT.items() for x in pair))[F.col("part")]
    total = F.sum("n").over(Window.partitionBy())
    shares = counted.select("part", (F.abs(F.col("n") / total - wanted) < 0.03).alias("near_its_share"))
    return shares.crossJoin(named.agg(F.count(F.lit(1)).alias("all_rows"), F.countDistinct("event_id").alias("distinct_rows")))


def bernoulli_sample_rows(spark, sf_dir):
    """A tenth, give or take, of the rows, each at most once and none from elsewhere."""
    events = _events(spark, sf_dir).select("event_id", "value")
    sample = bernoulli_sample(events, 0.1, seed=3)
    strange = sample.join(events, ["event_id", "value"], "left_anti")
    counted = sample.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("d"))
    return (
        counted.crossJoin(strange.agg(F.count(F.lit(1)).alias("strange_rows")))
        .crossJoin(events.agg(F.count(F.lit(1)).alias("all_rows")))
        .select(
            "all_rows",
            "strange_rows",
            (F.col("n") - F.col("d")).alias("repeated_rows"),
            (F.abs(F.col("n") / F.col("all_rows") - 0.1) < 0.03).alias("near_its_share"),
        )
    )


# --- unseen rows -----------------------------------------------------------------------------------


def _training_orders(spark, sf_dir):
    return _order_rows(spark, sf_dir).filter("o_orderpriority != '4-NOT SPECIFIED' AND o_orderstatus != 'P'")


def _daily_orders(spark, sf_dir):
    return blank_to_null(dirty_orders(spark, sf_dir), ["o_orderstatus"]).drop("o_totalprice")


_CATEGORIES = ["o_orderstatus", "o_orderpriority"]


def unseen_row_capture(spark, sf_dir):
    daily = _daily_orders(spark, sf_dir)
    fitted = indexer(daily, _CATEGORIES).fit(_training_orders(spark, sf_dir))
    return unseen_rows(daily, fitted.transform(daily))


def unscorable_row_capture(spark, sf_dir):
    fitted = indexer(_daily_orders(spark, sf_dir), _CATEGORIES).fit(_training_orders(spark, sf_dir))
    return unscorable_rows(_daily_orders(spark, sf_dir), dict(zip(_CATEGORIES, fitted.labelsArray)))


def scorable_row_filter(spark, sf_dir):
    daily = _daily_orders(spark, sf_dir)
    fitted = indexer(daily, _CATEGORIES).fit(_training_orders(spark, sf_dir))
    return scorable_rows(daily, dict(zip(_CATEGORIES, fitted.labelsArray)))


def unseen_by_category_report(spark, sf_dir):
    return unseen_by_category(_daily_orders(spark, sf_dir), _training_orders(spark, sf_dir), _CATEGORIES)


# --- drift -----------------------------------------------------------------------------------------


def _line_sides(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(*MEASURES, "l_returnflag", "l_linestatus", "l_shipdate")
    early = F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp")
    return lines.filter(early).drop("l_shipdate"), lines.filter(~early).drop("l_shipdate")


def _event_sides(spark, sf_dir):
    events = _events(spark, sf_dir).select("ts", "value", "event_type")
    return events.filter(_MIDDLE).drop("ts"), events.filter(f"NOT ({_MIDDLE})").drop("ts")


_NUMERIC = [*MEASURES, "value"]
_CATEGORICAL = ["l_returnflag", "l_linestatus", "event_type"]


def _statistic(spark, sf_dir, columns: list[str], names: list[str]) -> DataFrame:
    found = [D.drift_statistics(*sides(spark, sf_dir), columns=columns) for sides in (_line_sides, _event_sides)]
    both = found[0].unionByName(found[1])
    return both.select("column", *(F.round(F.col(name), 6).alias(name) for name in names))


def drift_ks(spark, sf_dir):
    return _statistic(spark, sf_dir, _NUMERIC, ["ks"])


def drift_wasserstein(spark, sf_dir):
    return _statistic(spark, sf_dir, _NUMERIC, ["wasserstein", "wasserstein_normed"])


def drift_js(spark, sf_dir):
    return _statistic(spark, sf_dir, _CATEGORICAL, ["jensen_shannon"])


def drift_chi2(spark, sf_dir):
    return _statistic(spark, sf_dir, _CATEGORICAL, ["chi2"])


def _line_report(spark, sf_dir):
    return D.drift_report(*_line_sides(spark, sf_dir), RUN_DATE)


def drift_column_report(spark, sf_dir):
    return _line_report(spark, sf_dir).withColumn("statistic", F.round("statistic", 6))


def drift_profile_report(spark, sf_dir):
    """The same report from a profile of the reference, stored in two parts, and a scan of the current rows."""
    reference, current = _line_sides(spark, sf_dir)
    returned = F.col("l_returnflag") == "R"
    profile = write_profile(reference.filter(returned), new_folder(spark, "profile"))
    profile = add_to_profile(profile, reference.filter(~returned), new_folder(spark, "profile"))
    return report_against(profile, current, RUN_DATE).withColumn("statistic", F.round("statistic", 6))


def drift_small_reference(spark, sf_dir):
    """Suppliers against customers by p-values, as suits a small reference."""
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")

    def accounts(table: str, prefix: str) -> DataFrame:
        rows = _table(spark, sf_dir, table)
        placed = rows.join(nations, rows[f"{prefix}_nationkey"] == nations["n_nationkey"])
        return placed.select(F.col(f"{prefix}_acctbal").alias("acctbal"), F.col("n_regionkey").alias("regionkey"))

    settings = D.DriftSettings(method="p-value")
    report = D.drift_report(accounts("supplier", "s"), accounts("customer", "c"), RUN_DATE, settings=settings)
    return report.withColumn("statistic", F.round("statistic", 6))


def drift_dataset_flag(spark, sf_dir):
    return D.dataset_flag(_line_report(spark, sf_dir))


def _segment_means(lines: DataFrame) -> DataFrame:
    means = lines.groupBy("l_quantity").agg(F.avg("l_extendedprice").alias("prediction"))
    few = is_small(lines.select("l_quantity").distinct())
    return lines.join(F.broadcast(means) if few else means, "l_quantity")


def _target_flag(spark, sf_dir):
    reference, current = _line_sides(spark, sf_dir)
    report = D.target_drift_report(reference, _segment_means(current), "l_extendedprice", run_date=RUN_DATE)
    return D.dataset_flag(report, "model_drift_detected")


def target_drift_flag(spark, sf_dir):
    return _target_flag(spark, sf_dir)


def drift_alerts(spark, sf_dir):
    return D.alerts(drift_dataset_flag(spark, sf_dir), _target_flag(spark, sf_dir))


def drift_turns(spark, sf_dir):
    """Flags of five days against a stored profile, kept in a table by date, and the days on which one turns true."""
    events = _events(spark, sf_dir).select("ts", "event_type")
    profile = write_profile(events.filter(_MIDDLE).drop("ts"), new_folder(spark, "profile"))
    settings = D.DriftSettings(distance_threshold=0.045)
    name = f"default.flag_history_{uuid.uuid4().hex}"
    for day in ("2024-01-18", "2024-01-19", "2024-01-21", "2024-01-23", "2024-01-25"):
        current = events.filter(F.to_date("ts") == F.lit(day)).drop("ts")
        report = report_against(profile, current, day, settings=settings)
        create_or_upsert(D.flag_rows(D.dataset_flag(report, settings=settings)), name, ["date", "alert"])
    return D.turned_on(spark.table(name))


def skewed_columns(spark, sf_dir):
    """Keys stay, every value is replaced by a finite one, and the draws follow the columns they were fitted to.

    Drift does not fire between a column and its draws, and does between a column and the draws of another one. The
    draws are written once: each of the comparisons would compute their hashes again, one even to lay out its work."""
    lines = _lines(spark, sf_dir).select(*LINE_KEYS, *MEASURES)
    folder = new_folder(spark, "skewed")
    drawn = skew_numeric(lines, LINE_KEYS, MEASURES)
    drawn.write.parquet(folder)
    skewed = spark.read.schema(drawn.schema).parquet(folder)
    keys = lines.select(*LINE_KEYS).exceptAll(skewed.select(*LINE_KEYS))
    finite = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in MEASURES))
    close = D.drift_statistics(lines, skewed, columns=MEASURES).agg(F.bool_and(F.col("ks") < 0.3).alias("close_to_the_columns"))
    turned = skewed.select(*LINE_KEYS, *(F.col(c).alias(n) for c, n in zip(MEASURES[1:] + MEASURES[:1], MEASURES)))
    fired = D.drift_report(lines.select(*MEASURES), turned.select(*MEASURES), RUN_DATE)
    fired = fired.agg(F.count_if("drifted").alias("columns_that_fire"))
    return (
        skewed.agg(F.count(F.lit(1)).alias("all_rows"), F.count_if(~finite).alias("unfinished_rows"))
        .crossJoin(keys.agg(F.count(F.lit(1)).alias("lost_keys")))
        .crossJoin(close)
        .crossJoin(fired)
    )


def defect_injection(spark, sf_dir):
    orders = _order_rows(spark, sf_dir)
    unknown = orders.filter("o_orderpriority = '1-URGENT'")
    blank = orders.filter("o_orderpriority = '5-LOW'")
    mixed = append_variants(
        orders,
        [
            (unknown, {"o_orderpriority": F.lit("No Such Policy"), "o_orderstatus": F.lit("No Such Status")}),
            (blank, {"o_orderpriority": F.lit(" "), "o_orderstatus": F.lit(" ")}),
        ],
    )
    return blank_to_null(mixed, ["o_orderstatus"])


# --- models ----------------------------------------------------------------------------------------


def category_index(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select("p_brand", "p_type")
    indexed = indexer(parts).fit(parts).transform(parts)
    reports = [
        indexed.groupBy(F.col(c).alias("category"), F.col(f"{c}_Index").cast("long").alias("category_index"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("column", F.lit(c))
        for c in parts.columns
    ]
    return reduce(DataFrame.unionByName, reports)


def rmse_by_split(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(*LINE_KEYS, "l_quantity", "l_extendedprice")
    labelled = with_split(_segment_means(lines), LINE_KEYS, SPLIT)
    return rmse(labelled, "l_extendedprice", by=["split"]).withColumn("rmse", F.round("rmse", 4))


def predicted_target(spark, sf_dir):
    predicted = predictions_as(_segment_means(_lines(spark, sf_dir)), "l_extendedprice")
    return predicted.select(F.round("l_extendedprice", 4).alias("l_extendedprice"))


def predictor_target_profile(spark, sf_dir):
    profile = target_profile(_table(spark, sf_dir, "part"), "p_size", "p_retailprice")
    return profile.withColumn("avg_target", F.round("avg_target", 4))


_FEATURES = ["l_returnflag", "l_linestatus", *MEASURES]


def _feature_lines(spark, sf_dir):
    return _lines(spark, sf_dir).select(*LINE_KEYS, *_FEATURES)


def _charged_lines(spark, sf_dir):
    """Lines with a price that follows from quantity, discount and tax; that of the table follows from none of them."""
    charge = F.col("l_quantity") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return _feature_lines(spark, sf_dir).withColumn("l_extendedprice", charge)


def _line_parts(spark, sf_dir):
    return hash_split(_feature_lines(spark, sf_dir), LINE_KEYS, SPLIT)


#: A forest that learned nothing has an error of one standard deviation of the target.
ERROR_SHARE = 1 / 3


def train_and_score(spark, sf_dir):
    """Rows scored of each part, and whether the error is below a third of the target's deviation."""
    lines = with_split(_charged_lines(spark, sf_dir), LINE_KEYS, SPLIT)
    training = lines.filter("split = 'train'").select(*_FEATURES)
    model = train(training, "l_extendedprice", numTrees=5, maxDepth=8)
    scored = score(model, lines.select("split", *_FEATURES))
    spread = F.stddev_pop("l_extendedprice").alias("spread")
    parts = scored.groupBy("split").agg(F.count(F.lit(1)).alias("rows_scored"), spread)
    errors = rmse(scored, "l_extendedprice", by=["split"])
    return parts.join(errors, "split").select("split", "rows_scored", F.col("rmse").between(0, ERROR_SHARE * F.col("spread")).alias("error_in_bounds"))


def forest_feature_importance(spark, sf_dir):
    """Every feature has a score from 0 to 1, they sum to 1, and quantity tells most about the price."""
    lines = _charged_lines(spark, sf_dir).select(*_FEATURES)
    model = train(lines, "l_extendedprice", numTrees=10, maxDepth=10)
    found = feature_importance(model, score(model, lines))
    everything = Window.partitionBy()
    kept = Window.partitionBy().orderBy("place")
    found = found.withColumn("place", F.monotonically_increasing_id())
    return found.select(
        "name",
        "idx",
        (F.coalesce(F.lag("score").over(kept), F.lit(1.0)) >= F.col("score")).alias("in_order"),
        F.col("score").between(0, 1).alias("in_range"),
        (F.abs(F.sum("score").over(everything) - 1) < 1e-6).alias("whole"),
        (F.col("score") == F.max("score").over(everything)).alias("foremost"),
    )


def tune_forest(spark, sf_dir):
    """Two candidates from the full search space with the values drawn, their log, and the newest saved model scoring
    the test part."""
    parts = {name: df.select(*_FEATURES) for name, df in hash_split(_charged_lines(spark, sf_dir), LINE_KEYS, SPLIT).items()}
    done = tune(
        parts["train"], parts["validation"], "l_extendedprice", evaluations=2, model_folder=new_folder(spark, "models")
    )
    newest = PipelineModel.load(latest_model(done.runs, "forest").first().model_path)
    scored = score(newest, parts["test"])
    tested = rmse(scored, "l_extendedprice").crossJoin(scored.agg(F.stddev_pop("l_extendedprice").alias("spread")))
    bounds = {name: (axis.start, axis.end) for name, axis in FOREST_SPACE.items()}
    in_space = reduce(
        lambda a, b: a & b, (F.when(F.col("key") == k, F.col("value").between(*v)).otherwise(True) for k, v in bounds.items())
    )
    trials = done.runs.filter("parent_id is not null").withColumn("drawn", F.when(F.col("kind") == "param", F.col("value")))
    logged = trials.groupBy("run_name", "kind", "key", "drawn").agg(
        F.count(F.lit(1)).alias("entries"), F.bool_and(in_space & (F.col("value") > 0)).alias("as_declared")
    )
    logged = logged.withColumnRenamed("drawn", "value")
    return logged.unionByName(
        tested.select(
            F.lit("forest").alias("run_name"),
            F.lit("test").alias("kind"),
            F.lit("rmse_test").alias("key"),
            F.lit(1).cast("long").alias("entries"),
            F.col("rmse").between(0, ERROR_SHARE * F.col("spread")).alias("as_declared"),
            F.lit(None).cast("double").alias("value"),
        )
    )


def latest_model_run(spark, sf_dir):
    """Every event as a run of its type; clicks above a value saved their model."""
    runs = _events(spark, sf_dir).select(
        F.col("event_type").alias("run_name"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("started_at"),
        F.when(F.col("value") > 1, F.concat(F.lit("models/"), "event_id")).alias("model_path"),
    )
    return latest_model(runs, "click")


def newest_run_per_group(spark, sf_dir):
    events = _events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value")
    return newest_per_group(events, "user_id", "ts", "event_id").drop("ts")


def daily_scoring(spark, sf_dir):
    """Train on one part, score another with unknown and null flags in it, capture those rows, flag drift.

    Row counts, the drift statistic of every column, the data set's flag, and the number of verdicts on the target."""
    parts = _line_parts(spark, sf_dir)
    training = parts["train"].select(*_FEATURES)
    model = train(training, "l_extendedprice", numTrees=5, maxDepth=8)
    flag = F.when(F.col("l_returnflag") == "A", "X").when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_returnflag"))
    daily = parts["test"].withColumn("l_returnflag", flag)
    namespace = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{new_folder(spark, namespace)}'")
    names = DailyTables(
        **{f: f"{namespace}.{f}" for f in DailyTables.__dataclass_fields__}
    )
    predictions = score_daily(daily, model, names, daily.schema, LINE_KEYS)
    reference = _feature_lines(spark, sf_dir).select(*_FEATURES)
    monitor(reference, daily, predictions, "l_extendedprice", tables=names, run_date=RUN_DATE)
    counts = row_count_verdicts({"daily": daily, "predicted": predictions, "unseen": spark.table(names.unseen)})
    report = counts.select(F.col("layer").alias("item"), F.col("row_count").cast("double").alias("value"))
    columns = spark.table(names.data_drift_report).filter(F.col("date") == RUN_DATE)
    report = report.unionByName(columns.select(F.col("column").alias("item"), F.round("statistic", 6).alias("value")))
    flags = spark.table(names.data_drift_flag).filter(F.col("date") == RUN_DATE)
    report = report.unionByName(
        flags.select(F.lit("drift_detected").alias("item"), F.col("drift_detected").cast("double").alias("value"))
    )
    judged = spark.table(names.target_drift_flag).filter(F.col("date") == RUN_DATE)
    return report.unionByName(
        judged.agg(F.count("model_drift_detected").cast("double").alias("value")).select(F.lit("target_verdicts").alias("item"), "value")
    )


QUERIES: dict[str, Query] = {
    "medallion_flagship": medallion_flagship,
    "medallion_tables": medallion_tables,
    "silver_clean": silver_clean,
    "drop_incomplete_rows": drop_incomplete_rows,
    "drop_blank_rows": drop_blank_rows,
    "distinct_without_lineage": distinct_without_lineage,
    "nullify_blank": nullify_blank,
    "gold_composite_score": gold_composite_score,
    "gold_score_correction": gold_score_correction,
    "sql_composite_function": sql_composite_function,
    "conform_schema": conform_schema,
    "expect_warn_counts": expect_warn_counts,
    "expect_null_passes": expect_null_passes,
    "expect_fail_gate": expect_fail_gate,
    "layer_row_counts": layer_row_counts,
    "upsert_composite_key": upsert_composite_key,
    "upsert_unique_target": upsert_unique_target,
    "upsert_null_keys": upsert_null_keys,
    "upsert_hot_target_key": upsert_hot_target_key,
    "upsert_ambiguous_matches": upsert_ambiguous_matches,
    "upsert_latest_wins": upsert_latest_wins,
    "create_or_upsert": create_or_upsert_table,
    "incremental_ingest": incremental_ingest,
    "bucketed_ingest": bucketed_ingest,
    "bucketed_merge": bucketed_merge,
    "maintained_gold": maintained_gold,
    "ingest_late_delivery": ingest_late_delivery,
    "ingest_long_versions": ingest_long_versions,
    "malformed_update_keeps_row": malformed_update_keeps_row,
    "distinct_latest_lineage": distinct_latest_lineage,
    "stream_after_snapshot": stream_after_snapshot,
    "stream_new_checkpoint": stream_new_checkpoint,
    "stream_refused_batch": stream_refused_batch,
    "layer_row_verdicts": layer_row_verdicts,
    "rejected_publish": rejected_publish,
    "refused_rows": refused_rows,
    "internal_run": internal_run,
    "external_run": external_run,
    "latest_model_run": latest_model_run,
    "stream_upsert": stream_upsert,
    "stream_to_parquet": stream_to_parquet,
    "stream_evolving": stream_evolving_schema,
    "csv_scan_malformed": csv_scan_malformed,
    "csv_scan_strings": csv_scan_strings,
    "ingest_high_water_mark": ingest_high_water_mark,
    "hash_split": hash_split_labels,
    "hash_sample": hash_sample_rows,
    "random_split": random_split_counts,
    "bernoulli_sample": bernoulli_sample_rows,
    "unseen_rows": unseen_row_capture,
    "unscorable_rows": unscorable_row_capture,
    "scorable_rows": scorable_row_filter,
    "unseen_by_category": unseen_by_category_report,
    "drift_ks": drift_ks,
    "drift_wasserstein": drift_wasserstein,
    "drift_js": drift_js,
    "drift_chi2": drift_chi2,
    "drift_report": drift_column_report,
    "drift_profile_report": drift_profile_report,
    "drift_turns": drift_turns,
    "drift_small_reference": drift_small_reference,
    "drift_dataset_flag": drift_dataset_flag,
    "target_drift_flag": target_drift_flag,
    "drift_alerts": drift_alerts,
    "skew_numeric": skewed_columns,
    "defect_injection": defect_injection,
    "category_index": category_index,
    "rmse_by_split": rmse_by_split,
    "predicted_target": predicted_target,
    "predictor_target_profile": predictor_target_profile,
    "train_and_score": train_and_score,
    "feature_importance": forest_feature_importance,
    "tune_forest": tune_forest,
    "newest_run_per_group": newest_run_per_group,
    "daily_scoring": daily_scoring,
}
