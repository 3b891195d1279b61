"""Language identification by prediction by partial matching over bytes."""

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import HashIndex, sampled_per_class

ORDER = 4
UNKNOWN = "und"
#: The fit reads about this many documents of each language; longer ones than this many characters as windows of so many.
FIT_ROWS, FIT_CHARS = 300, 30_000
_BLOCK = 1 << 19
_LETTER = regex.compile(r"\p{L}")
_PAD = b"\0" * ORDER


def _codes(data: np.ndarray, length: int) -> np.ndarray:
    """The last `length` bytes up to each position from ORDER on, as one number."""
    code = np.zeros(len(data) - ORDER, dtype=np.uint64)
    for back in range(length - 1, -1, -1):
        code = code << np.uint64(8) | data[ORDER - back : len(data) - back].astype(np.uint64)
    return code


def _tagged(code: np.ndarray, length: int, context: bool) -> np.ndarray:
    return code | np.uint64((length + 1) << 56 | int(context) << 63)


class ByteTrees:
    """Frozen context trees of all languages, flattened to the code length of every byte string they have seen.

    A byte costs -log2(c / (n + q)) in the longest context in which its language has seen it c times, of n bytes of q
    kinds there; every longer known context on the way down costs an escape, -log2(q / (n + q)). Below the empty
    context all 256 bytes are equally likely. Escapes are not excluded from the lower orders. Strings of up to
    ORDER + 1 bytes that any language has seen are stored with the costs for all languages, so one look-up replaces a
    walk down the trees.
    """

    def __init__(self, texts: Mapping[str, Sequence[bytes]]):
        self.languages = sorted(texts)
        count = len(self.languages)
        seen = []
        for language in self.languages:
            data = np.frombuffer(b"".join(_PAD + t for t in texts[language] if t) or _PAD, dtype=np.uint8)
            real = data[ORDER:] > 0
            seen.append([np.unique(_codes(data, m + 1)[real], return_counts=True) for m in range(ORDER + 1)])
        keys, values = [], []
        lower, lower_cost = None, None
        self._floor = np.zeros(count)
        for m in range(ORDER + 1 if seen else 0):
            strings = np.unique(np.concatenate([s[m][0] for s in seen]))
            contexts = np.unique(strings >> np.uint64(8))
            below = (
                np.full((len(strings), count), 8.0)
                if lower is None
                else lower_cost[np.searchsorted(lower, strings & np.uint64((1 << 8 * m) - 1))]
            )
            cost, escape = below.copy(), np.zeros((len(contexts), count))
            for i in range(count):
                code, c = seen[i][m]
                if not len(code):
                    continue
                context, first, kinds = np.unique(code >> np.uint64(8), return_index=True, return_counts=True)
                total = np.add.reduceat(c, first)
                escape[np.searchsorted(contexts, context), i] = -np.log2(kinds / (total + kinds))
                cost[:, i] += escape[np.searchsorted(contexts, strings >> np.uint64(8)), i]
                own = np.repeat(np.arange(len(context)), kinds)
                cost[np.searchsorted(strings, code), i] = -np.log2(c / (total[own] + kinds[own]))
            keys += [_tagged(strings, m, False), _tagged(contexts, m, True)]
            values += [cost, escape]
            if m == 0 and len(escape):
                self._floor = 8.0 + escape[0]
            lower, lower_cost = strings, cost
        self._index = HashIndex(np.concatenate([*keys, np.zeros(0, np.uint64)]))
        self._cost = np.concatenate([*values, np.zeros((1, count))]).astype(np.float32)  # the last is what -1 finds

    def _bits(self, data: np.ndarray) -> np.ndarray:
        """Cost of every byte from position ORDER on, for each language."""
        out = np.zeros((len(data) - ORDER, len(self.languages)), dtype=np.float32)
        left = None
        for m in range(ORDER, -1, -1):
            code = _codes(data, m + 1) if left is None or len(left) * 3 > len(out) else None
            if code is None:
                code = np.zeros(len(left), dtype=np.uint64)
                for back in range(m, -1, -1):
                    code = code << np.uint64(8) | data[left + (ORDER - back)].astype(np.uint64)
            elif left is not None:
                code = code[left]
            found = self._index.find(_tagged(code, m, False))
            if left is None:
                out += self._cost[found]
                missed = np.flatnonzero(found < 0)
                left = missed
            else:
                out[left] += self._cost[found]
                missed = np.flatnonzero(found < 0)
                left = left[missed]
            if not len(left):
                break
            if m:
                context = self._index.find(_tagged(code[missed] >> np.uint64(8), m, True))
                out[left] += self._cost[context]
            else:
                out[left] += self._floor.astype(np.float32)
        return out

    def code_lengths(self, texts: Sequence[bytes]) -> np.ndarray:
        """Bits that each language needs for each whole text."""
        total = np.zeros((len(texts), len(self.languages)))
        pieces, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), _BLOCK):
                pieces.append((text[at - ORDER : at] if at else _PAD) + text[at : at + _BLOCK])
                owners.append(i)
                size += len(pieces[-1])
                if size >= _BLOCK:
                    self._add(total, pieces, owners)
                    pieces, owners, size = [], [], 0
        if pieces:
            self._add(total, pieces, owners)
        return total

    def _add(self, total: np.ndarray, pieces: list[bytes], owners: list[int]) -> None:
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(length)
        bits = self._bits(data)
        start, stop = ends - length, ends - ORDER  # positions in `bits`: the first ORDER bytes of a piece only lead in
        bounds = np.empty(2 * len(pieces), np.int64)
        bounds[0::2], bounds[1::2] = start, stop
        bounds[-1] = min(bounds[-1], len(bits) - 1) if stop[-1] >= len(bits) else bounds[-1]
        sums = np.add.reduceat(bits.astype(np.float64), bounds[:-1] if stop[-1] >= len(bits) else bounds, axis=0)[0::2]
        np.add.at(total, owners, sums)


def predict(trees: ByteTrees, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    The score is the language's posterior when all are equally likely beforehand: 1 for a long clear text. Null texts
    and texts without a letter are UNKNOWN at score 0, and so is every text if no language was learned. A tie goes to
    the first language by name.
    """
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if t is not None and trees.languages and _LETTER.search(t)]
    if known:
        bits = trees.code_lengths([texts[i].encode("utf-8", "surrogatepass") for i in known])
        best = bits.argmin(axis=1)
        gap = bits - bits.min(axis=1, keepdims=True)
        scores[known] = 1.0 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
        for i, b in zip(known, best.tolist(), strict=True):
            names[i] = trees.languages[b]
    return names, scores


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    keys: Sequence[str] = ("doc_id",),
    rows: int = FIT_ROWS,
    chars: int = FIT_CHARS,
) -> ByteTrees:
    """Trees of the languages named in `lang`, from about `rows` documents of each, chosen by the hash of `keys`.

    A text of more than `chars` characters counts as several documents, its windows, so long texts teach as others do
    and what is read stays bounded. Rows with a null language or text and empty texts are not learned from. Repeated
    rows are chosen together. An empty table gives trees of no language. Only the columns named are read.
    """
    usable = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    named = [F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]
    windows = usable.select(
        F.col(lang).alias("__lang"), F.col(text).alias("__text"), *named,
        F.explode(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / chars).cast("int"))).alias("__at"),
    )
    # The first window has a null number, which the hash passes over: a short text is chosen by its keys alone.
    windows = windows.withColumn("__window", F.when(F.col("__at") > 0, F.col("__at")))
    chosen = sampled_per_class(windows, "__lang", [*(f"__key{i}" for i in range(len(keys))), "__window"], rows)
    by_language: dict[str, list[bytes]] = {}
    read = F.substring("__text", F.col("__at") * chars + 1, F.lit(chars)).cast("binary").alias("text")
    for row in chosen.select(F.col("__lang").alias("lang"), read).toLocalIterator():
        by_language.setdefault(row["lang"], []).append(bytes(row["text"]))
    return ByteTrees({k: sorted(v) for k, v in by_language.items()})


def language(trees: ByteTrees, docs: DataFrame, text: str = "text") -> Column:
    """A struct of lang and score for the whole text of each row of `docs`, however long; see `predict` for null and empty
    texts and ties. Repeated rows get the same; an empty table gives no row. Only the text is read."""
    model = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by the fit's sample
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = predict(model.value, texts.tolist())
            yield pd.DataFrame({"lang": lang, "score": score})

    return F.pandas_udf(predicted, kind)(F.col(text))
