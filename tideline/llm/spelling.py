"""Spelling variants: words one edit apart, found by bit-sliced position indexes over groups of the vocabulary.

Two words one edit apart agree in a prefix of half the shorter one's length or in the suffix after it. Words that share
such a part meet in a group; there a bitset for each (position, letter) says which words have that letter there, and
one pass over a query's letters moves the sets of words reached without an error and with one of each kind along.
"""

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import if_small, written

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, DELETED_ONE_IN, FORM_FACTOR = 6, 5, 199, 5
#: Words an index holds; a larger group is dealt to several indexes, each of which all the group's words ask.
INDEX_WORDS = 2048
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class PositionIndex:
    """Bitsets over a list of words: bit i of `at[p][letter]` is set if word i has that letter at position p."""

    def __init__(self, words: Sequence[str]):
        longest = max(map(len, words), default=0)
        members: list[defaultdict[str, list[int]]] = [defaultdict(list) for _ in range(longest)]
        lengths: defaultdict[int, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            lengths[len(word)].append(i)
            for p, letter in enumerate(word):
                members[p][letter].append(i)
        self.every = (1 << len(words)) - 1
        self.at: list[dict[str, int]] = [{k: _bits(v) for k, v in letters.items()} for letters in members]
        self.at += [{}, {}]
        self.of_length = {n: _bits(v) for n, v in lengths.items()}

    def near(self, query: str, longer: bool = True, equal: bool = True, shorter: bool = True, apart_before: int = 0) -> int:
        """Bits of the words one edit from the query: those of its length plus one, its length, its length less one.

        With apart_before, words that have the query's first so many letters are left out.

        After each letter, `exact` holds the words that start as the query does so far, `replaced` those with one letter
        replaced, `added` those with a letter more and so read one position on, `dropped` those with a letter less.
        """
        exact, replaced, added, dropped, excluded = self.every, 0, self.every, 0, 0
        before: dict[str, int] = {}
        for p, letter in enumerate(query):
            if p >= len(self.at) - 1:
                return 0
            here = self.at[p].get(letter, 0)
            if apart_before and p == apart_before:
                excluded = exact
            dropped = (dropped & before.get(letter, 0)) | exact
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
            added = (added & self.at[p + 1].get(letter, 0)) | exact
            before = self.at[p]
        n, found = len(query), 0
        if longer:
            found |= added & self.of_length.get(n + 1, 0)
        if equal:
            found |= replaced & self.of_length.get(n, 0)
        if shorter:
            found |= dropped & self.of_length.get(n - 1, 0)
        return found & ~excluded


def _bits(members: list[int]) -> int:
    raw = bytearray(members[-1] // 8 + 1)
    for i in members:
        raw[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(raw, "little")


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words that are long and frequent enough, all occurrences in all texts counted."""
    spelled = F.translate(F.col(text), UPPER, LOWER)
    runs = F.filter(F.regexp_extract_all(spelled, F.lit(RUN), F.lit(0)), lambda r: F.length(r) >= LEAST_LENGTH)
    found = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    found = found.select("run", h.alias("h")).withColumn("p", (F.col("h") % F.length("run")).cast("int"))
    cut = F.expr("concat(left(run, p), substring(run, p + 2))")
    word = F.when(F.col("h") % DELETED_ONE_IN == 0, cut).otherwise(F.col("run"))
    counts = found.groupBy(word.alias("word")).agg(F.count("*").alias("n"))
    return counts.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def _groups(words: DataFrame) -> DataFrame:
    """(shorter, side, part, word, n): the groups a word is in, as the shorter one of a pair or as the longer."""
    entries = []
    for less in (0, 1):
        shorter = F.length("word") - less
        k = F.floor(shorter / 2).cast("int")
        for side, part in (("prefix", F.left("word", k)), ("suffix", F.right("word", shorter - k))):
            entries.append(F.struct(shorter.cast("int").alias("shorter"), F.lit(side).alias("side"), part.alias("part")))
    return words.select(F.explode(F.array(*entries)).alias("g"), "word", "n").select("g.*", "word", "n")


_FOUND = "word string, n_near long, form_n long, form string"


def _near(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (group, index, query after index, n downwards, word): what each word has near it there.

    The index's words lie in the order of preference as forms, so the lowest bit of a result is the best.
    """
    group: tuple | None = None
    index: PositionIndex | None = None
    words: list[str] = []
    counts: list[int] = []
    out: list[tuple[str, int, int, str]] = []

    def ask(word: str) -> None:
        nonlocal index
        if index is None:
            index = PositionIndex(words)
        shorter, side = group[:2]
        own = len(word) == shorter
        apart = shorter // 2 if side == "suffix" else 0
        bits = index.near(word, longer=own, equal=own, shorter=not own, apart_before=apart)
        if bits:
            best = (bits & -bits).bit_length() - 1
            out.append((word, bits.bit_count(), counts[best], words[best]))

    def made() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n_near", "form_n", "form"])

    alone = False
    for batch in rows:
        cells = (batch.column(i).to_pylist() for i in range(batch.num_columns))
        for shorter, side, part, place, indexes, asks, word, n in zip(*cells, strict=True):
            if group != (shorter, side, part, place):
                if alone:
                    for own in words:
                        ask(own)
                group, index, alone = (shorter, side, part, place), None, indexes == 1
                words, counts = [], []
            if asks:
                ask(word)
            else:
                words.append(word)
                counts.append(n)
        if len(out) > 10_000:
            yield made()
    if alone:
        for own in words:
            ask(own)
    yield made()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of the words with a near one: how many, and the most frequent, the smaller of equals.

    A pair is counted in one group only: in a suffix group, words that share the prefix too are left out. A group of
    more than INDEX_WORDS words is dealt to several indexes, which its words ask one by one, so a task holds one index.
    """
    groups = _groups(words)
    key = ["shorter", "side", "part"]
    sizes = groups.groupBy(*key).agg(F.ceil(F.count("*") / INDEX_WORDS).cast("int").alias("indexes"), F.count("*").alias("size"))
    rows = groups.join(sizes.filter("size > 1").drop("size"), key)
    own = F.pmod(F.xxhash64("word"), F.col("indexes")).cast("int")
    everywhere = F.when(F.col("indexes") > 1, F.sequence(F.lit(0), F.col("indexes") - 1))
    stored = rows.select(*key, own.alias("place"), "indexes", F.lit(False).alias("asks"), "word", "n")
    asked = rows.select(*key, F.explode(everywhere).alias("place"), "indexes", F.lit(True).alias("asks"), "word", "n")
    found = (
        stored.unionByName(asked)
        .repartition(*key, "place")
        .sortWithinPartitions(*key, "place", "asks", F.desc("n"), "word")
        .mapInArrow(_near, _FOUND)
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, twice as far in each round.

    Counts grow at least FORM_FACTOR times with each step, so a chain is short and never closes.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(now.join(if_small(ahead), "root", "left").select("word", "root", "next"), "spelling-roots")
        now = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.filter("next IS NOT NULL").isEmpty():
            return now


def variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of the vocabulary: word, n, n_near, form, form_n, root.

    Words are maximal runs of Latin letters, A-Z in lower case, of which one in DELETED_ONE_IN, chosen by document and
    run, loses a letter. A word's form is its near word of the largest count, the smaller in code-point order of equals,
    if that count is at least FORM_FACTOR times its own; its root is the last form of the chain. A null or empty text
    has no words; a null id is the empty text where it chooses. Repeated rows count as often as they occur, very long
    texts whole. Other columns are not read, whatever their names. An empty table gives no row.
    """
    words = written(vocabulary(docs, id_column, text), "spelling-words")
    near = near_words(words).withColumnRenamed("form", "best").withColumnRenamed("form_n", "best_n")
    is_form: Column = F.col("best_n") >= FORM_FACTOR * F.col("n")
    named = written(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
