"""Near-duplicate vectors: randomly rotated binary codes choose the pairs whose cosine is computed."""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import if_small, written
from tideline.llm.components import components
from tideline.llm.vectors import comparable, pair_cosines, unit

#: Rows of a part of a crowded bucket, and rows that are compared at once.
PART_ROWS, CHUNK_ROWS = 2048, 1 << 14
_PAIRS = 1 << 20


@dataclass(frozen=True)
class Codes:
    """Signs of a unit vector after random rotations, with what corrects for them.

    A rotated vector P v is coded by its signs, the corner c = sign(P v) / sqrt(D). With the stored factor f = <c, P v>,
    <c, P w> / f is an estimate of <v, w> without bias for a random rotation, and it lies within
    sureness * sqrt((1 - f^2) / f^2) / sqrt(D - 1) of it but for a chance that falls as exp(-sureness^2 / 2). The mean
    over the rotations narrows the bound by the root of their number.

    The same signs are cut into `tables` keys of `bits` each. Vectors that share a key of any table are compared: at a
    cosine of 0.9 two signs agree with probability 0.856, so the defaults miss fewer than 1 in 10,000 such pairs, and fewer
    above. The buckets grow with the rows, and the work with their square: longer keys need more tables for the same
    chance, 80 for 12 bits. A lower threshold needs more tables too.
    """

    bits: int = 10
    tables: int = 40
    sureness: float = 4.0
    seed: int = 5

    def rotations(self, dimensions: int) -> int:
        return -(-self.bits * self.tables // dimensions)


@lru_cache(maxsize=8)
def _rotations(codes: Codes, dimensions: int) -> np.ndarray:
    """Random orthogonal matrices side by side: dimensions x (rotations * dimensions)."""
    rng = np.random.default_rng([codes.seed, dimensions])
    out = []
    for _ in range(codes.rotations(dimensions)):
        q, r = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out, axis=1)


def encode(codes: Codes, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signs packed to bytes, factor of every rotation) of unit vectors."""
    d = x.shape[1]
    rotated = (x @ _rotations(codes, d)).reshape(len(x), -1, d)
    factors = np.abs(rotated).sum(axis=2) / np.sqrt(d)
    return np.packbits((rotated >= 0).reshape(len(x), -1), axis=1), factors


def keys(codes: Codes, packed: np.ndarray) -> np.ndarray:
    """Key of each row in every table, cut from its signs."""
    n = codes.bits * codes.tables
    signs = np.unpackbits(packed, axis=1)[:, :n].reshape(len(packed), codes.tables, codes.bits)
    return signs @ (1 << np.arange(codes.bits))


def estimators(codes: Codes, packed: np.ndarray, factors: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the vector whose product with another unit vector estimates their cosine, and the bound."""
    r = factors.shape[1]
    corners = (np.unpackbits(packed, axis=1)[:, : r * d].astype(np.float64) * 2 - 1) / np.sqrt(d)
    weighted = corners.reshape(-1, r, d) / factors[:, :, None] / r
    bound = codes.sureness * np.sqrt(((1 - factors**2) / factors**2).sum(axis=1)) / r / np.sqrt(max(1, d - 1))
    return weighted.reshape(len(packed), -1) @ _rotations(codes, d).T, bound


def _links(codes: Codes, threshold: float, rows: pd.DataFrame) -> pd.DataFrame:
    """Links within the buckets of rows that are sorted by bucket: per row how many vectors, and the row to link with."""
    d = int(rows["d"].iloc[0])
    body = np.frombuffer(b"".join(rows["body"]), np.uint8).reshape(len(rows), -1)
    r = codes.rotations(d)
    factors = np.ascontiguousarray(body[:, : 8 * r]).view("<f8")
    width = body.shape[1] - 8 * r - -(-r * d // 8)
    exact = np.ascontiguousarray(body[:, 8 * r : 8 * r + width]).view(f"<f{width // d}").astype(np.float64)
    packed = np.ascontiguousarray(body[:, 8 * r + width :])
    found_keys, (guess, bound), near = keys(codes, packed), estimators(codes, packed, factors, d), unit(exact)
    table, part = rows["table"].to_numpy(), rows["part"].to_numpy()
    crossing = rows["crossing"].to_numpy()
    weight = rows["n"].to_numpy()
    group = np.cumsum(np.r_[False, (rows[["table", "bucket", "cell"]].ne(rows[["table", "bucket", "cell"]].shift())).any(axis=1)[1:]])
    count, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
    kept: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        ok = ~crossing[a] | (part[a] != part[b])
        a, b = a[ok], b[ok]
        likely = np.einsum("ij,ij->i", guess[a], near[b]) + bound[a] >= threshold
        a, b = a[likely], b[likely]
        first = (found_keys[a] == found_keys[b]).argmax(axis=1) == table[a]  # else another table brings the pair
        a, b = a[first], b[first]
        linked = pair_cosines(exact, a, exact, b) >= threshold
        a, b = a[linked], b[linked]
        np.add.at(count, a, weight[b])
        np.add.at(count, b, weight[a])
        if len(a):
            kept.append((a, b))

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size, shift, at = 0, 1, np.arange(len(rows))
    while len(at):
        at = at[at + shift < len(rows)]
        at = at[group[at] == group[at + shift]]
        waiting.append((at, at + shift))
        size += len(at)
        shift += 1
        if size >= _PAIRS or not len(at):
            compare(*(np.concatenate(side) for side in zip(*waiting, strict=True)))
            waiting, size = [], 0
    if kept:
        a, b = (np.concatenate(side) for side in zip(*kept, strict=True))
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
    hit = np.flatnonzero(count)
    names = rows["class"].to_numpy()
    return pd.DataFrame({"class": names[hit], "links": count[hit], "root": names[label[hit]]})


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    codes: Codes | None = None,
    id_column: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row per vector: the id, n_links, component_id and kept.

    Equal vectors are one class from the start, so copies cost nothing further. Classes that share a key of any table
    meet in a task; a bucket of more than PART_ROWS classes is dealt to parts, and every two parts meet in a task of
    their own. A pair is looked at in the first table that brings it together: if its estimate plus the bound reaches
    the threshold, its cosine is computed in double precision, and only that decides. Tasks return counts and one link
    a row, never pairs.

    Vectors that are null, empty, zero or hold a null or a number that isn't finite link with nothing: no links, their
    own id as component. Only vectors of the same length are compared. Repeated rows are vectors of their own. Null ids
    are passed over in the minimum and never kept. An empty table gives no row.
    """
    codes = codes or Codes()
    named = vectors.select(F.col(id_column).alias("id"), F.col(embedding).alias("v"), comparable(embedding).alias("ok"))
    name = F.concat(F.hex(F.xxhash64("v")), F.hex(F.hash("v")))
    rows = written(
        named.select("id", "ok", F.when(F.col("ok"), name).alias("class"), F.when(F.col("ok"), F.col("v")).alias("v")),
        "vectors",
    )
    classes = written(
        rows.filter("ok")
        .groupBy("class")
        .agg(F.min("id").alias("least"), F.count("*").alias("n"), F.first("v").alias("v")),
        "vector-classes",
    )

    stored = "<f4" if dict(vectors.dtypes)[embedding] == "array<float>" else "<f8"

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, some in batch.groupby(batch["v"].map(len)):
                x = np.stack(some["v"].tolist()).astype("<f8")
                sent = x.astype(stored)
                packed, factors = encode(codes, unit(x))
                body = [f.tobytes() + v.tobytes() + c.tobytes() for f, v, c in zip(factors.astype("<f8"), sent, packed, strict=True)]
                where = keys(codes, packed)
                yield pd.DataFrame({
                    "class": some["class"].to_numpy(), "n": some["n"].to_numpy(), "d": np.int32(d), "body": body,
                    "buckets": list(where.astype(np.int64)),
                })

    coded = written(
        classes.select("class", "n", "v").mapInPandas(keyed, "class string, n long, d int, body binary, buckets array<long>"),
        "vector-codes",
    )
    spread = coded.select("class", "n", "d", F.posexplode("buckets").alias("table", "bucket"), "body")
    crowded = (
        coded.select("d", F.posexplode("buckets").alias("table", "bucket"))
        .groupBy("d", "table", "bucket")
        .agg(F.count("*").alias("size"))
        .filter(F.col("size") > PART_ROWS)
        .withColumn("parts", F.ceil(F.col("size") / PART_ROWS).cast("int"))
        .drop("size")
    )
    parts = F.coalesce("parts", F.lit(1))
    met = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.least("part", other) * F.col("parts") + F.greatest("part", other),
    )
    dealt = (
        spread.join(if_small(crowded), ["d", "table", "bucket"], "left")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
        .withColumn("cell", F.explode(met))
        .withColumn("crossing", F.floor(F.col("cell") / F.col("parts")) != F.col("cell") % F.col("parts"))
        .select("class", "n", "d", "table", "bucket", "part", "cell", "crossing", "body")
    )
    group = ["d", "table", "bucket", "cell"]

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < CHUNK_ROWS:
                continue
            rows = pd.concat(held, ignore_index=True)
            last = (rows[group] == rows[group].iloc[-1]).all(axis=1).to_numpy()
            whole = len(rows) - int(last[::-1].argmin()) if not last.all() else 0
            yield from by_length(rows.iloc[:whole])
            held = [rows.iloc[whole:]]
        if held:
            yield from by_length(pd.concat(held, ignore_index=True))

    def by_length(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, some in rows.groupby("d"):
            yield _links(codes, threshold, some.reset_index(drop=True))

    links = written(
        dealt.repartition(*group).sortWithinPartitions(*group).mapInPandas(linked, "class string, links long, root string"),
        "vector-links",
    )
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")))
    rooted = (
        classes.select("class", "least", "n")
        .join(counts, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(smallest, "root").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return (
        rows.select("id", "ok", "class")
        .join(known, "class", "left")
        .select(
            F.col("id").alias(id_column),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        )
    )
