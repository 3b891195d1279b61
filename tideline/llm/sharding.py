"""Contiguous shards of the smallest possible capacity over groups that stay together."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import if_small, written

SHARDS = 8
#: Hex digits of the group key that the first summary and each finer one add: 4,096 and 256 bins.
FIRST_DIGITS, MORE_DIGITS = 3, 2
KEY_DIGITS = 32
_INDEX_BITS = 33


@dataclass
class Summary:
    """Sizes along the order of the groups: bins named by a prefix of the group key, whole or a single group."""

    prefix: np.ndarray
    size: np.ndarray
    single: np.ndarray

    def sorted(self) -> "Summary":
        order = np.argsort(self.prefix)
        return Summary(self.prefix[order], self.size[order], self.single[order])


def _cuts(ends: np.ndarray, single: np.ndarray, capacity: int, shards: int, divisible: bool) -> list[int]:
    """Where greedily filled shards end, as positions in bytes.

    `divisible`: bins that hold several groups may be cut anywhere, which can only help; else no bin is cut.
    """
    at, out = 0, []
    for _ in range(shards):
        reach = at + capacity
        i = int(np.searchsorted(ends, reach, side="right"))
        if i == len(ends):
            at = int(ends[-1]) if len(ends) else 0
        elif divisible and not single[i]:
            at = reach
        else:
            at = int(ends[i - 1]) if i and ends[i - 1] > at else at
        out.append(at)
    return out


def smallest_capacity(size: np.ndarray, single: np.ndarray, shards: int, divisible: bool = False) -> int:
    """Least capacity with which greedily filled shards hold everything, by binary search."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    low, high = -(-total // shards), total
    while low < high:
        middle = (low + high) // 2
        if _cuts(ends, single, middle, shards, divisible)[-1] >= total:
            high = middle
        else:
            low = middle + 1
    return low


def _level(size: np.ndarray, shards: int) -> float:
    """Mean of what shards get, those apart that a group above the mean takes by itself."""
    while shards > 1 and len(size) and size.max() > (mean := size.sum() / shards):
        heavy = size > mean
        size, shards = size[~heavy], shards - int(heavy.sum())
    return float(size.sum()) / max(1, shards)


def even_cuts(size: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Where shards of at most `capacity` end, each as near as can be to the mean of what is left for it and the rest.

    A cut is no earlier than the rest allows: filled from the end, the later shards must hold what follows.
    """
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    starts = ends - size
    least = [total]
    for _ in range(shards - 1):
        i = int(np.searchsorted(starts, least[-1] - capacity))
        least.append(int(starts[i]) if i < len(starts) else total)
    at, out = 0, []
    for left in range(shards, 0, -1):
        wanted = at + _level(size[starts >= at], left)
        i = int(np.searchsorted(ends, wanted))
        near = [int(e) for e in ends[max(0, i - 1) : i + 1] if e > at]
        most = int(np.searchsorted(ends, at + capacity, side="right"))
        reach = int(ends[most - 1]) if most else at
        cut = min(near, key=lambda e: abs(e - wanted)) if near else at
        at = max(at, min(max(cut, least[left - 1]), reach))
        out.append(at)
    return out


def _to_split(s: Summary, shards: int) -> list[str]:
    """Bins that a cut may fall into, as far as the summary tells."""
    ends = np.cumsum(s.size)
    low = smallest_capacity(s.size, s.single, shards, divisible=True)
    high = smallest_capacity(s.size, s.single, shards)
    least = _cuts(ends, s.single, low, shards, divisible=False)
    most = _cuts(ends, s.single, high, shards, divisible=True)
    starts = ends - s.size
    wanted = np.zeros(len(ends), dtype=bool)
    for a, b in zip(least[:-1], most[:-1], strict=True):
        wanted |= (ends > a) & (starts < b)
    if low < high:  # a bin heavier than the capacity can be the cause by itself
        wanted |= s.size > low
    return list(s.prefix[wanted & ~s.single])


def _binned(groups: DataFrame, digits: int, within: list[str] | None) -> Summary:
    prefix = F.substring("__key", 1, digits)
    if within is not None:
        groups = groups.filter(F.substring("__key", 1, len(within[0])).isin(within))
    rows = groups.groupBy(prefix.alias("p")).agg(F.sum("__size").alias("s"), F.count("*").alias("n")).collect()
    return Summary(
        np.array([r.p for r in rows], dtype=object),
        np.array([r.s for r in rows], dtype=np.int64),
        np.array([r.n == 1 for r in rows], dtype=bool),
    ).sorted()


def shard_starts(groups: DataFrame, shards: int) -> list[str]:
    """Prefix of the group key with which each shard but the first starts.

    The exact smallest capacity, though the driver never sees more than a summary: bins of the key's leading digits,
    split further only where a cut may fall. The bins to split number a few per shard, whatever the table's size.
    """
    digits = FIRST_DIGITS
    s = _binned(groups, digits, None)
    while split := _to_split(s, shards):
        by_length: dict[int, list[str]] = {}
        for p in split:
            by_length.setdefault(len(p), []).append(p)
        gone = np.isin(s.prefix, split)
        parts = [Summary(s.prefix[~gone], s.size[~gone], s.single[~gone])]
        parts += [_binned(groups, min(KEY_DIGITS, n + MORE_DIGITS), ps) for n, ps in by_length.items()]
        s = Summary(
            np.concatenate([x.prefix for x in parts]),
            np.concatenate([x.size for x in parts]),
            np.concatenate([x.single for x in parts]),
        ).sorted()
    ends = np.cumsum(s.size)
    capacity = smallest_capacity(s.size, s.single, shards)
    starts = []
    for cut in even_cuts(s.size, capacity, shards)[:-1]:
        i = int(np.searchsorted(ends, cut, side="right")) if cut else 0
        starts.append(s.prefix[i] if i < len(ends) else "g")  # above every hex digit: the shard is empty
    return starts


def text_size(text: str) -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def shard_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: the id, size, text_crc32, shard and slot.

    Documents of equal text form a group that stays together; groups are ordered by the md5 of their text. Shards are
    contiguous in that order and none is above the smallest capacity that holds everything; below it, each is cut near
    the mean of what is left. A group heavier than the mean sets the capacity, and the others share the rest. Slots number a shard's documents from 0 without gaps, by
    (md5, id).

    Null text: size 1, CRC 0, a group of its own beside the empty text. Null ids come first within a group; equal rows
    get a slot each. With fewer groups than shards the last shards stay empty; an empty table gives no row.
    """
    body = F.col(text).cast("binary")
    key = F.when(F.col(text).isNull(), F.lit("0" * KEY_DIGITS)).otherwise(F.md5(body))
    rows = docs.select(
        F.col(id_column),
        text_size(text).alias("size"),
        F.coalesce(F.crc32(body), F.lit(0)).alias("text_crc32"),
        key.alias("__key"),
    )
    order = [F.col("__key"), F.col(id_column)]
    ranked = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()),
        "shards",
    )
    groups = written(ranked.groupBy("__key").agg(F.sum("size").alias("__size")), "shard-groups")
    shard = F.lit(0)
    for start in shard_starts(groups, shards):
        shard = shard + (F.col("__key") >= F.lit(start)).cast("int")
    part = F.shiftright("__at", _INDEX_BITS)
    placed = ranked.withColumn("shard", shard).withColumn("__part", part)
    counts = placed.groupBy("__part", "shard").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("__part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    # place in the shard = place in the partition - rows of earlier shards there + the shard's rows in earlier partitions
    offsets = counts.select(
        F.col("__part").alias("__p"),
        F.col("shard").alias("__s"),
        (F.coalesce(F.sum("__n").over(earlier), zero) - F.coalesce(F.sum("__n").over(ahead), zero)).alias("__offset"),
    )
    index = F.col("__at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return placed.join(if_small(offsets), (F.col("__part") == F.col("__p")) & (F.col("shard") == F.col("__s"))).select(
        id_column, "size", "text_crc32", "shard", (index + F.col("__offset")).alias("slot")
    )
