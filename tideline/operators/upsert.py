"""Keyed upsert with MERGE semantics, as joins over DataFrames.

Matched target rows take the update's columns, unmatched updates are inserted, other target rows stay. A null
key matches nothing, so null-keyed rows of both sides pass through without being shuffled to one partition.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.cleaning import all_not_null


# Rows up to which an update's side is broadcast; checked by counting, not estimated.
BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most `rows` rows. Every task sends one number, whatever the frame's size."""
    return df.count() <= rows


class DuplicateKeys(Exception):
    """Several update rows have the same key."""


def duplicate_keys(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one update row carries, with their row count. Counted on the map side first."""
    return (
        updates.filter(all_not_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("update_rows"))
        .filter("update_rows > 1")
    )


def ambiguous_matches(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate update keys that hit a target row: the case in which MERGE fails."""
    return duplicate_keys(updates, keys).join(target.select(*keys).distinct(), list(keys), "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest `order_by` values per key; ties go to the greatest remaining columns.

    An aggregate rather than a ranking window: rows of a hot key are reduced before the shuffle. Null-keyed
    rows are all kept.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    newest = F.max(F.struct(*order_by, *rest)).alias("_newest")
    keyed = all_not_null(keys)
    kept = df.filter(keyed).groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)
    return kept.unionByName(df.filter(~keyed))


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    unique_target: bool = False,
    newer_by: str | None = None,
    small_updates: bool = False,
) -> DataFrame:
    """`target` after merging `updates`, in the target's columns.

    Updates may lack target columns: matched rows keep theirs, inserted rows get null. Keys have to be unique in
    the updates (see `ambiguous_matches`, `latest_per_key`), not in the target; a caller who knows the target
    keys to be unique can say so, and the merge is one outer join. With newer_by, a matched row is replaced only where
    the update's value of that column is not below its own, for updates that may arrive out of order.

    small_updates (see `is_small`) broadcasts the updates, and no target row is shuffled. Without it large updates
    are safe: the target is the left side of its join, which adaptive execution splits where a key is hot, and its
    keys are made distinct, on the map side first, before they are compared.
    """
    keys = list(keys)
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"update columns missing from the target: {unknown}")
    keyed = all_not_null(keys)
    keyed_target, keyed_updates = target.filter(keyed), updates.filter(keyed)

    replaced = set(updates.columns) - set(keys)

    def replaces(current: str) -> Column:
        taken = F.col("_update").isNotNull()
        if newer_by:
            taken &= F.coalesce(F.col(f"_update.{newer_by}") >= F.col(current), F.lit(True))
        return taken

    packed = keyed_updates.select(*keys, F.struct(*updates.columns).alias("_update"))
    if unique_target and not small_updates:
        # Every key has at most one row on either side: one outer join, each side shuffled once, no key is hot.
        found = keyed_target.select(*keys, F.struct(*target.columns).alias("_row")).join(packed, keys, "full_outer")
        taken = replaces(f"_row.{newer_by}") if newer_by else replaces("")
        merged = found.select(
            *(
                F.col(c)
                if c in keys
                else F.when(taken, F.col(f"_update.{c}")).otherwise(F.col(f"_row.{c}")).alias(c)
                if c in replaced
                else F.col(f"_row.{c}").alias(c)
                for c in target.columns
            )
        )
        return (
            merged.unionByName(target.filter(~keyed))
            .unionByName(updates.filter(~keyed), allowMissingColumns=True)
            .select(*target.columns)
        )

    sent = F.broadcast if small_updates else lambda df: df
    taken = replaces(newer_by or "")
    merged = keyed_target.join(sent(packed), keys, "left").select(
        *(
            F.when(taken, F.col(f"_update.{c}")).otherwise(F.col(c)).alias(c)
            if c in replaced
            else F.col(c)
            for c in target.columns
        )
    )
    present = keyed_target.select(*keys)
    if small_updates:
        present = present.join(F.broadcast(keyed_updates.select(*keys)), keys, "left_semi")
    inserted = keyed_updates.join(sent(present.distinct()), keys, "left_anti")
    return (
        merged.unionByName(target.filter(~keyed))
        .unionByName(inserted, allowMissingColumns=True)
        .unionByName(updates.filter(~keyed), allowMissingColumns=True)
        .select(*target.columns)
    )


def row_changes(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    newer_by: str | None = None,
    small_updates: bool = False,
    change: str = "_change",
) -> DataFrame:
    """What `upsert` does to the target, row by row: those that go with -1 in `change`, those that come with 1.

    The target's columns and `change`. Adding the changes to the copies of the target's rows gives the copies of the
    result's rows. An update that replaces several rows of one key comes as often as it replaces.
    """
    keys = list(keys)
    keyed, replaced = all_not_null(keys), set(updates.columns) - set(keys)
    keyed_target, keyed_updates = target.filter(keyed), updates.filter(keyed)
    sent = F.broadcast if small_updates else lambda df: df
    packed = keyed_updates.select(*keys, F.struct(*updates.columns).alias("_update"))
    met = keyed_target.join(sent(packed), keys)
    if newer_by:
        met = met.filter(F.coalesce(F.col(f"_update.{newer_by}") >= F.col(newer_by), F.lit(True)))
    old = [F.col(c) for c in target.columns]
    new = [F.col(f"_update.{c}").alias(c) if c in replaced else F.col(c) for c in target.columns]
    both = F.array(F.struct(*old, F.lit(-1).alias(change)), F.struct(*new, F.lit(1).alias(change)))
    present = keyed_target.select(*keys)
    if small_updates:
        present = present.join(F.broadcast(keyed_updates.select(*keys)), keys, "left_semi")
    come = keyed_updates.join(sent(present.distinct()), keys, "left_anti").unionByName(updates.filter(~keyed))
    return met.select(F.inline(both)).unionByName(come.withColumn(change, F.lit(1)), allowMissingColumns=True)
