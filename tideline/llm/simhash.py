"""SimHash near-duplicates at a Hamming distance of 2, found by one-wildcard variants of 32-bit segments."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tideline.llm.common import if_small, written
from tideline.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 2
SEGMENTS, SEGMENT_BITS = 2, 32
#: Larger buckets are linked through shared neighbour points instead of pair by pair.
PAIR_BUCKET = 64


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each run of `size` words; bytes.lower and bytes.split know ASCII letters and white space only."""
    words = text.lower().split()
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1].tolist()
    ends = ends.tolist()
    if len(words) > size:
        pieces = [joined[s:e] for s, e in zip(starts, ends[size - 1 :], strict=False)]
    else:
        pieces = [joined] if words else []
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(p, SEED) for p in pieces), np.uint64, len(pieces))


def fingerprint_of(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint; 0 for a null text or one without words."""
    hashes = shingle_hashes(text, words) if text else ()
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for block in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[block : block + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> Column:
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.fromiter((fingerprint_of(text, words) for text in texts), np.int64, len(texts)))

    return F.pandas_udf(fingerprints, T.LongType())(F.col(text).cast("binary"))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _variants(fingerprints: DataFrame) -> DataFrame:
    """A row for each segment and wildcard: bits 32 to 37 of the key name the variant, the low bits are the rest."""
    segment = F.when(F.col("v") < SEGMENT_BITS, F.shiftrightunsigned("fp", SEGMENT_BITS)).otherwise(
        F.col("fp").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    )
    masked = F.expr(f"seg & ~shiftleft(1L, v % {SEGMENT_BITS})")
    return (
        fingerprints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS * SEGMENT_BITS - 1))).alias("v"))
        .withColumn("seg", segment)
        .select("fp", F.shiftleft(F.col("v").cast("long"), SEGMENT_BITS).bitwiseOR(masked).alias("key"))
    )


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _point_links(fingerprints: DataFrame) -> DataFrame:
    """Links among many close fingerprints without pairs.

    Two fingerprints differ in at most 2 bits just if some point lies within 1 bit of both. So each goes to its 65
    points, and all at a point are linked with the smallest there.
    """
    flipped = F.expr("CASE WHEN v = 64 THEN fp ELSE fp ^ shiftleft(1L, v) END")
    points = fingerprints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("v")).select(
        "fp", flipped.alias("point")
    )
    least = points.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    return points.join(least, "point").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) that connect just those of the distinct fingerprints `fp` that differ in at most 2 bits.

    Cut into two segments, two such fingerprints differ by at most one bit in one of them, so they share one of that
    segment's 32 variants with a bit left out. Equal variants are joined and verified. A bucket of more than
    PAIR_BUCKET fingerprints is not paired: its fingerprints are linked through shared points, which is as exact.
    """
    variants = _variants(fingerprints)
    buckets = written(
        variants.repartition("key")
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"),
        "simhash-buckets",
    )
    links = buckets.filter("n = 2").select("a", "b").filter(_near("a", "b"))
    crowded = buckets.filter("n > 2").select("key", "n")
    if not crowded.isEmpty():
        members = written(variants.join(if_small(crowded), "key"), "simhash-members")
        few = members.filter(F.col("n") <= PAIR_BUCKET)
        pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
        links = links.unionByName(pairs.filter("a < b").filter(_near("a", "b")).select("a", "b"))
        many = members.filter(F.col("n") > PAIR_BUCKET).select("fp").distinct()
        links = links.unionByName(_point_links(many).filter(_near("a", "b")))
    return links.distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, its fingerprint as a long `fp` and component_id.

    component_id is the smallest id reachable by links between fingerprints of at most 2 differing bits. Documents of
    equal fingerprints are one class from the start, so copies cost nothing further. A null or wordless text has
    fingerprint 0, which links as any other. Null ids are passed over in the minimum; a component of null ids only has
    a null component_id. Repeated rows each get their row. An empty table gives no row.
    """
    marked = written(docs.select(F.col(id_column).alias("__id"), fingerprint(text).alias("fp")), "simhash")
    classes = written(marked.groupBy("fp").agg(F.min("__id").alias("least")), "simhash-classes")
    roots = components(fingerprint_links(classes.select("fp")))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("__id").alias(id_column), "fp", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, in their columns, whose id is their component's; of rows that repeat it, one stays."""
    return smallest_of_each(docs, near_duplicates(docs, id_column, text), id_column, text)


def smallest_of_each(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose id is the component_id that `found` gives it; of rows that repeat it, one stays.

    Of rows with the same id the one with the smallest md5 of its text stays. In a component of null ids only, one
    row stays: null ids are kept by the same rule.
    """
    kept = found.filter(F.col(id_column).eqNullSafe(F.col("component_id"))).select(F.col(id_column).alias("__id"))
    rows = docs.join(kept.distinct(), F.col(id_column).eqNullSafe(F.col("__id")), "left_semi")
    order = Window.partitionBy(id_column).orderBy(
        F.col(text).isNull(), F.md5(F.col(text).cast("binary")), F.xxhash64(*docs.columns)
    )
    return rows.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").select(*docs.columns)
