"""Log-likelihood of whole documents under a gated recurrent language model trained on the corpus itself.

Token counts cover every learning document. The most frequent tokens are words of the network; all others belong to
tail classes named by their last two bytes, whose chances within the class are those of the counts. The network is
trained on every learning document by tasks that each pass over their share and then have their weights averaged, so
what the driver holds is one set of weights and one bounded dictionary, whatever the corpus.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import gru
from tideline.llm.common import written

#: Tokens that a task counts before it hands the counts on.
HELD_TOKENS = 1 << 18


@dataclass(frozen=True)
class Settings:
    """words: tokens with vectors of their own. dictionary: tokens whose counts travel with the tasks; those of the
    others are joined. tails: classes of the tokens that are no words. size: of the state. rounds: the weights are
    averaged so many times, after as many parts of the learning documents. task_tokens: a task of a round gets that many
    tokens of the corpus, divided by the rounds. chunk_tokens: tokens of documents that are laid out at once.
    piece: a learning document's state is started afresh after so many tokens; a scored document's never is."""

    words: int = 2048
    dictionary: int = 1 << 16
    tails: int = 64
    classes: int = 16
    size: int = 24
    rounds: int = 4
    task_tokens: int = 4_000_000
    chunk_tokens: int = 1_000_000
    piece: int = 1024
    rate: float = 0.1
    seed: int = 0


def tokens_of(text: bytes | None) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII letters and white space only."""
    return (text or b"").lower().split()


def tail_class(token: bytes, tails: int) -> int:
    return zlib.crc32(token[-2:]) % tails


def _tail_class(token: str, tails: int) -> Column:
    raw = F.col(token).cast("binary")
    return F.crc32(F.substring(raw, F.greatest(F.octet_length(raw) - 1, F.lit(1)), F.lit(2))) % tails


@dataclass
class Lexicon:
    """What was counted in the learning documents.

    counts: (token, n) of every token but the end. known: the dictionary's tokens and counts by falling count, the
    end's not among them. ends: learning documents. total, types: tokens and distinct ones, the end included.
    tail_tokens, tail_types: the same for each tail class.
    """

    settings: Settings
    counts: DataFrame
    known: dict[bytes, int]
    ends: int
    total: int
    types: int
    tail_tokens: np.ndarray
    tail_types: np.ndarray

    @property
    def word_counts(self) -> np.ndarray:
        return np.array([self.ends, *list(self.known.values())[: self.settings.words - 1]], float)

    @property
    def shape(self) -> gru.Shape:
        counts = self.word_counts
        return gru.Shape(len(counts), self.settings.tails, gru.class_starts(counts, self.settings.classes), self.settings.size)


def count_tokens(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> Lexicon:
    """Counts of all tokens of all `docs`, those the model learns from."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                found.update(tokens_of(value.as_py()))
                if len(found) > HELD_TOKENS:
                    yield rows(found)
                    found = Counter()
        yield rows(found)

    def rows(found: Counter[bytes]) -> pa.RecordBatch:
        keys = pa.array(found.keys(), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([keys, pa.array(found.values(), pa.int64())], ["token", "n"])

    pairs = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(counted, "token string, n long")
    counts = written(pairs.groupBy("token").agg(F.sum("n").alias("n")), "lm-counts")
    known = {r["token"].encode(): r["n"] for r in _most_frequent(counts, settings.dictionary).collect()}
    ends = docs.count()
    tail_tokens, tail_types = np.zeros(settings.tails), np.zeros(settings.tails)
    total, types = ends, int(ends > 0)
    per_tail = counts.groupBy(_tail_class("token", settings.tails).alias("t")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    for r in per_tail.collect():
        tail_tokens[r["t"]], tail_types[r["t"]] = r["n"], r["v"]
        total, types = total + r["n"], types + r["v"]
    for token, n in list(known.items())[: settings.words - 1]:
        tail_tokens[tail_class(token, settings.tails)] -= n
        tail_types[tail_class(token, settings.tails)] -= 1
    return Lexicon(settings, counts, known, ends, total, types, tail_tokens, tail_types)


def _most_frequent(counts: DataFrame, rows: int) -> DataFrame:
    """The `rows` tokens of the largest counts, ties by token. A histogram of the counts, a few hundred rows, first says
    which counts cannot be among them, so that no task sends on tokens of others."""
    bucket = F.floor(F.log2("n") * 8)
    sizes = {r["b"]: r["size"] for r in counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("size")).collect()}
    least, held = None, 0
    for b in sorted(sizes, reverse=True):
        least, held = b, held + sizes[b]
        if held >= rows:
            break
    some = counts if least is None else counts.filter(bucket >= least)
    return some.orderBy(F.desc("n"), "token").limit(rows)


_ENCODED = (
    "row long, id {id}, learns boolean, ids array<short>, n_tokens long, n_known long, base double, fixed double, "
    "outside array<string>, times array<int>"
)


def encode(docs: DataFrame, learns: Column, lexicon: Lexicon, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document, written: its network inputs, and what the dictionary already says of its chances.

    base sums log10(c + 1) and fixed the log10 chances within tail classes, over the tokens in the dictionary; those
    outside are listed with their occurrences.
    """
    s = lexicon.settings
    words = len(lexicon.word_counts)
    room = lexicon.tail_tokens + lexicon.tail_types + 1
    table = {}
    for k, (token, n) in enumerate(lexicon.known.items()):
        if k + 1 < words:
            table[token] = k + 1
        else:
            table[token] = s.words + k
    log_count, log_inside = np.zeros(s.words + s.dictionary), np.zeros(s.words + s.dictionary)
    inputs = np.zeros(s.words + s.dictionary, np.int16)
    log_count[0] = math.log10(lexicon.ends + 1)
    for token, number in table.items():
        n = lexicon.known[token]
        log_count[number] = math.log10(n + 1)
        if number < words:
            inputs[number] = number
        else:
            t = tail_class(token, s.tails)
            log_inside[number], inputs[number] = math.log10((n + 1) / room[t]), words + t
    tails, ends = s.tails, lexicon.ends

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                cols: dict[str, list] = {k: [] for k in ("ids", "n_tokens", "n_known", "base", "fixed", "outside", "times")}
                for value in batch.column(3):
                    tokens = tokens_of(value.as_py())
                    numbers = np.fromiter(map(table.get, tokens, [-1] * len(tokens)), np.int32, len(tokens))
                    strange = np.flatnonzero(numbers < 0).tolist()
                    own = inputs[numbers]
                    own[strange] = [words + tail_class(tokens[i], tails) for i in strange]
                    others = Counter(tokens[i] for i in strange)
                    inside = numbers[numbers >= 0]
                    cols["ids"].append(np.append(own, np.int16(0)))
                    cols["n_tokens"].append(len(tokens) + 1)
                    cols["n_known"].append(len(inside) + (ends > 0))
                    cols["base"].append(float(log_count[inside].sum() + log_count[0]))
                    cols["fixed"].append(float(log_inside[inside].sum()))
                    cols["outside"].append([t.decode() for t in others])
                    cols["times"].append(list(others.values()))
                flat = np.concatenate(cols["ids"])
                offsets = np.cumsum([0, *map(len, cols["ids"])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), batch.column(2),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int16())),
                        pa.array(cols["n_tokens"], pa.int64()), pa.array(cols["n_known"], pa.int64()),
                        pa.array(cols["base"], pa.float64()), pa.array(cols["fixed"], pa.float64()),
                        pa.array(cols["outside"], pa.list_(pa.string())), pa.array(cols["times"], pa.list_(pa.int32())),
                    ],
                    ["row", "id", "learns", "ids", "n_tokens", "n_known", "base", "fixed", "outside", "times"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"),
        F.coalesce(learns, F.lit(False)).alias("learns"), F.col(text).cast("binary").alias("text"),
    )
    kind = docs.schema[id_column].dataType.simpleString()
    return written(rows.mapInArrow(encoded, _ENCODED.format(id=kind)), "lm-encoded")


def _documents(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    lists = batch.column(column)
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def train(encoded: DataFrame, lexicon: Lexicon) -> gru.Arrays:
    """The network's weights after one pass over all learning documents of `encoded`, in rounds.

    In a round each task starts from the same weights, learns from its documents and hands its weights on; their mean,
    weighed by tokens, starts the next round. Sums are formed by a task per kind of weight that holds one running sum.
    """
    s, shape = lexicon.settings, lexicon.shape
    weights = gru.initial(shape, lexicon.word_counts, lexicon.tail_tokens, s.seed)
    tasks = max(1, math.ceil(lexicon.total / s.task_tokens))
    schema = "name string, task int, n long, body binary"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: Counter[str] = Counter()
        for batch in batches:
            for row in batch.to_pylist():
                part = row["n"] * np.frombuffer(row["body"], np.float32).astype(np.float64)
                sums[row["name"]] = sums[row["name"]] + part if row["name"] in sums else part
                seen[row["name"]] += row["n"]
        yield pa.RecordBatch.from_pylist(
            [{"name": k, "task": 0, "n": seen[k], "body": (v / seen[k]).astype(np.float32).tobytes()} for k, v in sums.items()],
            pa.schema([("name", pa.string()), ("task", pa.int32()), ("n", pa.int64()), ("body", pa.binary())]),
        )

    for r in range(s.rounds):
        start = weights

        def learned(batches: Iterator[pa.RecordBatch], start: gru.Arrays = start) -> Iterator[pa.RecordBatch]:
            net = gru.Network(shape, {k: v.copy() for k, v in start.items()})
            trainer = gru.Trainer(net, s.rate)
            waiting: list[np.ndarray] = []
            held = n = task = 0

            def learn() -> None:
                nonlocal held, n
                trainer.learn(waiting)
                n += held
                held = 0
                waiting.clear()

            for batch in batches:
                if batch.num_rows:
                    task = batch.column(0)[0].as_py()
                for doc in _documents(batch, 1):
                    waiting += [doc[a : a + s.piece] for a in range(0, len(doc), s.piece)]
                    held += len(doc)
                    if held >= s.chunk_tokens:
                        learn()
            if waiting:
                learn()
            if n:
                yield pa.RecordBatch.from_pylist(
                    [{"name": k, "task": task, "n": n, "body": v.tobytes()} for k, v in net.w.items()],
                    pa.schema([("name", pa.string()), ("task", pa.int32()), ("n", pa.int64()), ("body", pa.binary())]),
                )

        part = encoded.filter("learns").filter(F.pmod(F.xxhash64("row"), F.lit(s.rounds)) == r).coalesce(tasks)
        made = part.select(F.spark_partition_id().alias("task"), "ids").mapInArrow(learned, schema)
        means = made.repartition("name").sortWithinPartitions("name", "task").mapInArrow(summed, schema).collect()
        if means:
            weights = {m["name"]: np.frombuffer(m["body"], np.float32).reshape(weights[m["name"]].shape) for m in means}
    return weights


def score(encoded: DataFrame, lexicon: Lexicon, weights: gru.Arrays, id_column: str = "doc_id") -> DataFrame:
    """A row per document of `encoded`: the id, learns, n_tokens, n_known, train_tokens, base_score and score."""
    s, shape = lexicon.settings, lexicon.shape

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = gru.Network(shape, weights)
        rows: list[pa.Array] = []
        waiting: list[np.ndarray] = []

        def settle() -> pa.RecordBatch:
            ln = net.score(waiting)
            out = [pa.concat_arrays(rows), pa.array(ln / math.log(10))]
            rows.clear()
            waiting.clear()
            return pa.RecordBatch.from_arrays(out, ["row", "lm"])

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                few = batch.slice(start, 512)
                rows.append(few.column(0))
                waiting += _documents(few, 1)
                if sum(map(len, waiting)) >= 2 * s.chunk_tokens:
                    yield settle()
        if waiting:
            yield settle()

    lm = encoded.select("row", "ids").mapInArrow(scored, "row long, lm double")
    room = F.array(*(F.lit(float(x)) for x in lexicon.tail_tokens + lexicon.tail_types + 1))
    outside = encoded.select("row", F.explode(F.arrays_zip("outside", "times")).alias("o")).select(
        "row", F.col("o.outside").alias("token"), F.col("o.times").alias("times")
    )
    c = F.coalesce("n", F.lit(0))
    inside = F.log10((c + 1) / F.get(room, _tail_class("token", s.tails).cast("int")))
    strange = outside.join(lexicon.counts, "token", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.log10(c + 1.0) * F.col("times")).alias("counts"),
        F.sum(inside * F.col("times")).alias("inside"),
    )
    slot = math.log10(lexicon.total + lexicon.types + 1)
    zero = F.lit(0.0)
    return (
        encoded.select("row", "id", "learns", "n_tokens", "n_known", "base", "fixed")
        .join(written(lm, "lm-scores"), "row")
        .join(strange, "row", "left")
        .select(
            F.col("id").alias(id_column),
            "learns",
            "n_tokens",
            (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
            F.lit(lexicon.total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("counts", zero) - F.col("n_tokens") * F.lit(slot)).alias("base_score"),
            (F.col("lm") + F.col("fixed") + F.coalesce("inside", zero)).alias("score"),
        )
    )


def score_documents(
    docs: DataFrame, learns: Column, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: the id, learns, n_tokens, n_known, train_tokens, base_score and score, log10 chances.

    Tokens are runs without ASCII white space, A-Z in lower case, and an end. base_score is the add-one unigram law over
    the learning documents' tokens with a place for unknown ones; score is the network's chance of the whole text, read
    with one state from its first token to its end. A token outside the network's words has the chance of its tail
    class times its add-one share of the class, so the chances of all tokens sum to 1 with one unknown per class.

    A null, empty or blank text is an end alone. A null `learns` is false. Repeated rows each get their row and count as
    often as they occur; null ids stay null. Ties in count go to the smaller token. Very long texts are scored whole.
    Only the id, the text and what `learns` reads are used, so other columns may have any names; an id column named
    like one of the results is refused. Where nothing learns, base_score is 0 with train_tokens 0, and the network is
    the one it starts as. An empty table gives no row.
    """
    if id_column in ("learns", "n_tokens", "n_known", "train_tokens", "base_score", "score"):
        raise ValueError(f"the result has a column {id_column} of its own")
    lexicon = count_tokens(docs.filter(F.coalesce(learns, F.lit(False))), text, settings)
    encoded = encode(docs, learns, lexicon, id_column, text)
    return score(encoded, lexicon, train(encoded, lexicon), id_column)
