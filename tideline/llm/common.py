"""What the operators share: tables, intermediate files, bounded samples and a numpy hash index."""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.workspace import new_folder

#: Rows of a lookup table that may be broadcast.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back, so that later jobs see one fixed copy of it."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def if_small(df: DataFrame) -> DataFrame:
    """`df` marked for broadcast if it was counted to be small, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def id_crc(id_column: str) -> Column:
    """CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))


def hash_fraction(columns: Sequence[str], seed: str) -> Column:
    """A number in [0, 1) that only the columns and the seed decide."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def sampled_per_class(df: DataFrame, label: str, keys: Sequence[str], rows: int, seed: str = "sample") -> DataFrame:
    """About `rows` rows of each class, chosen by the hash of `keys`; all of a smaller class.

    The classes are counted first, so what is kept is bounded by the number of classes, whatever the input's size.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return df
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label).eqNullSafe(F.lit(value)), min(1.0, rows / n)).otherwise(share)
    return df.filter(hash_fraction(keys, seed) < share)


class HashIndex:
    """Positions of 64-bit keys, found many at a time: open addressing in numpy arrays."""

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, dtype=np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._at = np.full(1 << bits, -1, dtype=np.int32)
        self._key = np.zeros(1 << bits, dtype=np.uint64)
        place = self._first(keys)
        todo = np.arange(len(keys))
        while todo.size:
            free = todo[self._at[place[todo]] < 0]
            slots, first = np.unique(place[free], return_index=True)
            self._at[slots] = free[first]
            self._key[slots] = keys[free[first]]
            todo = todo[self._at[place[todo]] != todo]
            place[todo] = (place[todo] + 1) & self._mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self._FACTOR) >> self._shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is unknown."""
        place = self._first(keys)
        found = self._at[place]
        wrong = np.flatnonzero((self._key[place] != keys) & (found >= 0))
        place = place[wrong]
        while wrong.size:
            place = (place + 1) & self._mask
            now = self._at[place]
            found[wrong] = now
            on = (self._key[place] != keys[wrong]) & (now >= 0)
            wrong, place = wrong[on], place[on]
        return found
