"""Pseudo-random numbers that depend on the row's key alone, so reruns and any partitioning agree."""

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(keys: Sequence[str], seed: str = "") -> Column:
    """The md5 of seed and keys, as hexadecimal text."""
    return F.md5(F.concat_ws("|", *([F.lit(seed)] if seed else []), *(F.col(k).cast("string") for k in keys)))


def below(hashed: Column, share: float) -> Column:
    """Whether a hash is among the first `share` of all hashes.

    Equal to comparing its first 32 bits as a number in [0, 1), but on the text itself.
    """
    bound = math.ceil(share * 2**32)
    return F.lit(bound > 0) if bound in (0, 2**32) else hashed < f"{bound:08x}"


def hash_uniform(keys: Sequence[str], seed: str = "") -> Column:
    """A number in [0, 1) from the first 32 bits of the key's hash."""
    return F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def hash_normal(keys: Sequence[str], seed: str = "") -> Column:
    """A standard normal draw per key (Box and Muller 1958)."""
    radius = F.sqrt(-2.0 * F.log(1.0 - hash_uniform(keys, f"{seed}/radius")))
    return radius * F.cos(2.0 * math.pi * hash_uniform(keys, f"{seed}/angle"))
