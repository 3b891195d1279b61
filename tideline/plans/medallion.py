"""The layered data sets: bronze, silver and gold, each with its expectations."""

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import schemas
from tideline.operators.clean import to_silver
from tideline.operators.expectations import Rule, row_count_verdicts, rules
from tideline.operators.gold import to_gold
from tideline.sources.files import CORRUPT, VERSION
from tideline.sources.ingest import Feed, committed, compact, expire, land, table_folder
from tideline.sources.tables import drop_table, publish, scan_table
from tideline.workspace import delete_folder

# --- fixed values: expectations on the listing layers ------------------------------------------------
BRONZE_RULES = rules(
    {
        "cancellation_policy is not null": "cancellation_policy IS NOT NULL",
        "cancellation_policy is not blank": "cancellation_policy != ' '",
        "neighbourhood is not null": "neighbourhood_cleansed IS NOT NULL",
        "neighbourhood is not blank": "neighbourhood_cleansed != ' '",
    }
)
GOLD_RULES = rules(
    {
        "cancellation_policy is not null": "cancellation_policy IS NOT NULL",
        "cancellation_policy is not blank": "cancellation_policy != ' '",
        "neighbourhood is not null": "neighbourhood_cleansed IS NOT NULL",
        "neighbourhood is not blank": "neighbourhood_cleansed != ' '",
        "host_is_superhost is not null": "host_is_superhost IS NOT NULL",
        "host_is_superhost is not empty": "host_is_superhost != ''",
        "host_is_superhost is not blank": "host_is_superhost != ' '",
    },
    action="fail",
)
# Where the flag is known to be coded as a digit, as in test data: a stricter gate.
DEV_GOLD_RULES = [
    *GOLD_RULES,
    *rules({"host_is_superhost is a flag": "host_is_superhost IN ('0', '1')"}, action="fail"),
]
# -----------------------------------------------------------------------------------------------------


BRONZE_COMMENT = "rows as delivered"


@dataclass(frozen=True)
class Layers:
    """What a flow does beyond its source: the listing settings by default."""

    scores: Sequence[str] = field(default_factory=lambda: list(schemas.REVIEW_SCORES))
    composite: str = schemas.COMPOSITE
    target: str | None = None
    lineage: Sequence[str] = ()
    bronze_rules: Sequence[Rule] = field(default_factory=lambda: list(BRONZE_RULES))
    gold_rules: Sequence[Rule] = field(default_factory=lambda: list(GOLD_RULES))


def well_formed(bronze: DataFrame) -> DataFrame:
    """Bronze from files keeps malformed lines for inspection; they end there."""
    return bronze.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in bronze.columns else bronze


def layers(bronze: DataFrame, settings: Layers = Layers()) -> dict[str, DataFrame]:
    """Silver and gold as pure transformations of bronze."""
    silver = to_silver(well_formed(bronze), settings.lineage)
    gold = to_gold(silver, settings.scores, settings.composite, settings.target)
    return {"bronze": bronze, "silver": silver, "gold": gold}


@dataclass(frozen=True)
class Published:
    tables: Mapping[str, str]
    violations: Mapping[str, Mapping[str, int]]

    def row_counts(self, spark: SparkSession, expected: Mapping[str, int] | None = None) -> DataFrame:
        return row_count_verdicts({layer: spark.table(name) for layer, name in self.tables.items()}, expected)


def table_names(namespace: str, test_mode: bool) -> dict[str, str]:
    prefix = f"{namespace}.test_" if test_mode else f"{namespace}."
    return {layer: f"{prefix}{layer}" for layer in ("bronze", "silver", "gold")}


def _bronze_rules(bronze: DataFrame, settings: Layers) -> list[Rule]:
    formed = rules({"line is well formed": f"{CORRUPT} IS NULL"}) if CORRUPT in bronze.columns else []
    return [*settings.bronze_rules, *formed]


def _refine(
    spark: SparkSession, tables: Mapping[str, str], settings: Layers, root: str | None = None
) -> dict[str, int]:
    """Silver from the bronze table and gold from the silver table; returns the gold violations.

    With a root the files lie below it, and a copy that is replaced goes.
    """

    def folder(layer: str) -> str | None:
        return f"{root.rstrip('/')}/{tables[layer].split('.')[-1]}-{uuid.uuid4().hex}" if root else None

    silver = to_silver(well_formed(spark.table(tables["bronze"])), settings.lineage)
    publish(silver, tables["silver"], (), "complete, non-blank, distinct rows", folder("silver"), root is None)
    gold = to_gold(spark.table(tables["silver"]), settings.scores, settings.composite, settings.target)
    return publish(
        gold, tables["gold"], settings.gold_rules, "rows with the composite score", folder("gold"), root is None
    )


def publish_layers(
    bronze: DataFrame, settings: Layers = Layers(), namespace: str = "default", test_mode: bool = False
) -> Published:
    """Materialises the layers in order, each from the table before it.

    Bronze rules warn and are counted by the write itself; a violated gold rule leaves the gold table as it was.
    """
    spark = bronze.sparkSession
    tables = table_names(namespace, test_mode)
    if test_mode:
        for name in tables.values():
            drop_table(spark, name)
    violations = {"bronze": publish(bronze, tables["bronze"], _bronze_rules(bronze, settings), BRONZE_COMMENT)}
    violations["gold"] = _refine(spark, tables, settings)
    return Published(tables, violations)


def run_internal(
    spark: SparkSession, source_table: str, fraction: float = 1.0, seed: int = 42, **options
) -> Published:
    """The flow over a catalog table."""
    return publish_layers(scan_table(spark, source_table, fraction, seed), **options)


def run_external(
    spark: SparkSession,
    feed: Feed,
    root: str,
    name: str = "bronze",
    settings: Layers = Layers(lineage=(VERSION, schemas.LINEAGE)),
    namespace: str = "default",
    test_mode: bool = False,
    max_files: int | None = None,
    keep: int = 2,
) -> Published:
    """The flow over versioned files: land what is pending, merge it into bronze, then the layers.

    Bronze is written once per run: the snapshot that the next run merges into is also the published table. A run that
    finds nothing new writes nothing. Everything lies below `root`; the last `keep` snapshots stay for readers.
    """
    table, tables = table_folder(root, name, test_mode), table_names(namespace, test_mode)
    if test_mode:
        delete_folder(spark, table)
        for published in tables.values():
            drop_table(spark, published)
    landed = land(spark, feed, table, max_files)
    violations: dict[str, dict[str, int]] = {"bronze": {}, "gold": {}}
    behind = committed(spark, table, "deliveries")[-1:] > committed(spark, table, "snapshots")[-1:]
    if not landed and not behind and all(spark.catalog.tableExists(t) for t in tables.values()):
        return Published(tables, violations)

    def snapshot(bronze: DataFrame, folder: str) -> None:
        violations["bronze"] = publish(
            bronze, tables["bronze"], _bronze_rules(bronze, settings), BRONZE_COMMENT, folder
        )

    compact(spark, feed, table, snapshot)
    violations["gold"] = _refine(spark, tables, settings, root)
    expire(spark, table, keep)
    return Published(tables, violations)
