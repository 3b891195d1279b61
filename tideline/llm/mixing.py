"""Mixing sources to target weights by exact cuts in a hash-random order."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tideline.llm.common import if_small, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)

_SIZE, _SOURCE, _KEY, _PART, _BEFORE = "__mix_size", "__mix_source", "__mix_key", "__mix_part", "__mix_before"
_SOURCE_SIZE, _TARGET, _TAKEN = "__mix_source_size", "__mix_target", "__mix_taken"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame, source: str, size: str, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Adds `target` to one row per source.

    Sources in code-point order, null last, take the weights in turn and divide share * (sum of sizes) by them. No
    target exceeds most * size; what a source can't take goes to the others by weight. That is target =
    least(most * size, level * weight): with sources ordered by most * size / weight, the level is the greatest of
    (what is left when the earlier ones are full) / (weights from here on).
    """
    by_name = Window.orderBy(F.col(source).isNull(), F.col(source))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.lit(float(weights[0]))
    for i, w in enumerate(weights[1:], 1):
        weight = F.when(turn == i, float(w)).otherwise(weight)
    ranked = totals.withColumn("__w", weight).withColumn("__cap", F.col(size) * F.lit(most))
    filling = Window.orderBy(F.col("__cap") / F.col("__w"), F.col(source).isNull(), F.col(source))
    everywhere = Window.partitionBy()
    left = F.sum(size).over(everywhere) * F.lit(share) - F.coalesce(
        F.sum("__cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    level = left / F.sum("__w").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        ranked.withColumn("__level", level)
        .withColumn("target", F.least(F.col("__cap"), F.max("__level").over(everywhere) * F.col("__w")))
        .drop("__w", "__cap", "__level")
    )


def _running_sums(size_at: int, source_at: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            size = batch.column(size_at).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = batch.column(source_at).dictionary_encode(null_encoding="encode")
            code = codes.indices.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            before = np.cumsum(size) - size
            base = before[first].copy()
            names = [codes.dictionary[int(code[i])].as_py() for i in first]
            if last is not None and names[0] == last[0]:
                base[0] -= carried
            before -= np.repeat(base, np.diff(np.r_[first, n]))
            last, carried = (names[-1],), int(before[-1] + size[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before, pa.int64()), pa.array(np.full(n, part, np.int32))],
                schema=pa.schema([*batch.schema, pa.field(_BEFORE, pa.int64()), pa.field(_PART, pa.int32())]),
            )

    return sums


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: the id, the columns in `keep`, size, source_size, target and taken.

    Rows are range-sorted by source and the md5 of (seed, id), ties by the text's md5. Running sums of the sizes come
    from one pass within each partition and the totals of the partitions before it. A source of size s and budget
    b = floor(target) gives b div s whole epochs, then its first documents in that order up to the exact word: the one
    on the cut gives a part of its words.

    Null text or text without words: size 0, taken 0. A null source is a source of its own. Null ids count as the
    text 'null'. Equal rows are taken row by row; which of two equal rows stands on the cut makes no difference. An
    empty table gives no row. Other columns are not read.
    """
    chosen = list(dict.fromkeys([id_column, *keep]))
    mixed = _mix(docs, chosen, id_column, text, source, weights, share, most, seed)
    names = {_SIZE: "size", _SOURCE_SIZE: "source_size", _TARGET: "target", _TAKEN: "taken"}
    return mixed.select(*chosen, *(F.col(own).alias(name) for own, name in names.items()))


def _mix(docs, chosen, id_column, text, source, weights, share, most, seed) -> DataFrame:
    key = F.md5(F.concat(F.lit(seed + "/"), F.coalesce(F.col(id_column).cast("string"), F.lit("null"))).cast("binary"))
    tie = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.select(
        *chosen, word_count(text).alias(_SIZE), F.col(source).alias(_SOURCE), F.concat(key, tie).alias(_KEY)
    )
    order = [F.col(_SOURCE).isNull(), F.col(_SOURCE), F.col(_KEY)]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(_KEY)
    schema = T.StructType([*ranged.schema, T.StructField(_BEFORE, T.LongType()), T.StructField(_PART, T.IntegerType())])
    at = ranged.columns.index
    summed = written(ranged.mapInArrow(_running_sums(at(_SIZE), at(_SOURCE)), schema), "mix")

    parts = summed.groupBy(_PART, _SOURCE).agg(F.sum(_SIZE).alias("__n"))
    totals = (
        source_targets(
            parts.groupBy(_SOURCE).agg(F.sum("__n").alias(_SOURCE_SIZE)), _SOURCE, _SOURCE_SIZE, weights, share, most
        )
        .withColumnRenamed(_SOURCE, "__s")
        .withColumnRenamed("target", _TARGET)
    )
    earlier = Window.partitionBy(_SOURCE).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .join(totals, F.col(_SOURCE).eqNullSafe(F.col("__s")))
        .select(F.col(_PART).alias("__p"), "__s", "__offset", _SOURCE_SIZE, _TARGET)
    )
    whole = F.when(F.col(_SOURCE_SIZE) > 0, F.floor(F.floor(_TARGET) / F.col(_SOURCE_SIZE))).otherwise(0)
    rest = F.floor(_TARGET) - F.col("__whole") * F.col(_SOURCE_SIZE)
    cut = F.greatest(F.lit(0), F.least(F.col(_SIZE), rest - F.col(_BEFORE) - F.col("__offset")))
    return (
        summed.join(
            if_small(offsets), (F.col(_PART) == F.col("__p")) & F.col(_SOURCE).eqNullSafe(F.col("__s")), "left"
        )
        .withColumn("__whole", whole)
        .withColumn(_TAKEN, (F.col("__whole") * F.col(_SIZE) + cut).cast("long"))
    )


def _cut(text: Column, words: Column) -> Column:
    """The text up to the end of its `words`-th word."""
    found = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.concat_ws("", F.slice(found, F.lit(1), words.cast("int")))


def mixed_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, in the columns it came with.

    A document taken k whole times is there k times; if words are left over, once more with just those first words.
    A document of which no word is taken is not there. Nulls, ties and repeated rows are as in `mix`.
    """
    columns = docs.columns
    taken = _mix(docs, columns, id_column, text, source, weights, share, most, seed)
    epochs = F.when(F.col(_SIZE) > 0, F.floor(F.col(_TAKEN) / F.col(_SIZE))).otherwise(0)
    copies = (
        taken.withColumn("__epochs", epochs)
        .withColumn("__extra", F.col(_TAKEN) - F.col("__epochs") * F.col(_SIZE))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), (F.col("__epochs") + 1).cast("int"))))
        .filter((F.col("__copy") <= F.col("__epochs")) | (F.col("__extra") > 0))
    )
    whole = F.col("__copy") <= F.col("__epochs")
    cut = F.when(whole, F.col(text)).otherwise(_cut(F.col(text), F.col("__extra")))
    return copies.withColumn(text, cut).select(*columns)
