"""Toxicity by the difference in compressed length under a dictionary of toxic and one of ordinary text."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import hash_fraction

#: The fit reads about this many toxic and ordinary documents. Of a text of more than this many characters it reads
#: that many at most, in pieces from all over it.
FIT_TOXIC, FIT_ORDINARY, FIT_CHARS, FIT_PIECES = 1500, 3000, 30_000, 10
#: Words of a window that is compressed; words of the segments that a dictionary is made of (one, and sums of what there
#: is), and the bytes of a word's beginning that is a segment too. Bytes of the parts of a dictionary: common text, ordinary
#: words that a part of the toxic text could stand for, and what only its class has.
WINDOW, SPANS, STEM, COMMON_BYTES, LIKE_BYTES, OWN_BYTES = 6, ((1, 1), (2, 1), (3, 3)), 5, 32768, 32768, 8192
#: Bytes that a match costs, how many standard deviations a class' count of a segment is taken to be wrong, and how much
#: more its use in the other class weighs than that in its own.
MATCH, LEAST_MATCH, SURE, OTHER = 3, 6, 2.5, 2.0
#: The same where too few documents teach for that to leave a dictionary anything.
LESS_SURE = 1.75
#: Share of the ordinary documents of the fit that may score THRESHOLD or more under dictionaries that don't know them.
FALSE_ALARMS = 0.004
COPY_WORDS = 5
THRESHOLD = 0.7
#: Parts of the fit's texts that are scored by dictionaries of the other parts.
FOLDS = 8
_BYTES_AT_ONCE, _HASH_BITS = 1 << 22, 24
_TO_SPACE = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
#: Starts every window and ends both dictionaries, so that no window is too short to be compressed at all; and ends
#: every window, as matches don't begin in the last bytes.
_START = b"\0\1\2\3\4\5\6\7\x0e\x0f\x10\x11\x12\x13\x14\x15\x16\x17\x18\x19\x1a\x1b\x1c\x1d"
_END = b"\x1e\x1f\x0b\x0c\x7f\x1a\x02\x11"


def words_of(text: str) -> list[bytes]:
    """Lower-case words: letters and digits, and every character beyond ASCII."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def windows_of(words: Sequence[bytes]) -> list[bytes]:
    """The text of WINDOW words each, between blanks."""
    return [b" %b " % b" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]


def _signature(words: Sequence[bytes]) -> int:
    """The least hash of a run of COPY_WORDS words: near copies mostly agree in it, other documents hardly ever."""
    last = max(1, len(words) - COPY_WORDS + 1)
    return min(xxhash.xxh64_intdigest(b" ".join(words[i : i + COPY_WORDS])) for i in range(last))


class CompressionScore:
    """Two zstandard dictionaries of raw text and the logistic curve that turns their differences into a score.

    Both end with the same segments of common text, where a match costs least, so common text is as short under either.
    What stands before was taken from toxic documents in one and from ordinary documents in the other.
    """

    def __init__(self, common: bytes, toxic: bytes, ordinary: bytes):
        size = max(len(toxic), len(ordinary))
        self._content = tuple(b" " * (size - len(own)) + own + common + _START for own in (toxic, ordinary))
        self.weights = np.zeros(4)
        self._open()

    def __getstate__(self):
        return self._content, self.weights

    def __setstate__(self, state):
        self._content, self.weights = state
        self._open()

    def _open(self) -> None:
        settings = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=16, chain_log=16, search_log=5, min_match=LEAST_MATCH, target_length=16,
            strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_dict_id=False,
        )
        self._compressors = []
        for content in self._content:
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self._compressors.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=known))

    def differences(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """For each text, by how many bytes each window is shorter under the toxic dictionary."""
        block, size = [], 0
        for text in texts:
            block.append(windows_of(words_of(text)) if text else [])
            size += len(text or "")
            if size >= _BYTES_AT_ONCE:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, docs: list[list[bytes]]) -> Iterator[np.ndarray]:
        windows = [_START + w + _END for doc in docs for w in doc]
        if not windows:
            yield from (np.zeros(0, np.int64) for _ in docs)
            return
        length = np.fromiter(map(len, windows), np.uint64, len(windows))
        place = np.stack([np.cumsum(length) - length, length], axis=1).astype("<u8")
        data = zstandard.BufferWithSegments(b"".join(windows), place.tobytes())
        sizes = []
        for compressor in self._compressors:
            out = compressor.multi_compress_to_buffer(data, threads=0)
            sizes.append(np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out)))
        yield from np.split(sizes[1] - sizes[0], np.cumsum([len(doc) for doc in docs])[:-1])

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        """Per text: 1, the greatest gain of a window, the gain of all windows (log), and that gain per window."""
        rows = []
        for d in self.differences(texts):
            gain = float(np.maximum(d, 0).sum())
            rows.append((1.0, max(0.0, float(d.max())) if len(d) else 0.0, np.log1p(gain), gain / max(1, len(d))))
        return np.array(rows).reshape(-1, 4)

    def calibrate(self, features: np.ndarray, toxic: np.ndarray) -> None:
        """Ridge logistic regression of the labels on the features, by Newton's method; both classes weigh the same.

        The curve is then moved so that THRESHOLD leaves FALSE_ALARMS of the ordinary texts above it, and no text
        without a gain.
        """
        x, y = features, np.asarray(toxic, dtype=float)
        if not len(y):
            self.weights = np.zeros(4)
            return
        share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum())) * len(y)
        w, ridge = np.zeros(4), np.diag([1e-3, 0.05, 0.05, 0.05])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(
                x.T @ (x * (share * p * (1 - p))[:, None]) + ridge, x.T @ (share * (y - p)) - ridge @ w
            )
            w += step
            if np.abs(step).max() < 1e-8:
                break
        no_gain = w[0]
        scores = np.sort(x[y == 0] @ w)[::-1]
        if len(scores) and np.abs(w[1:]).max() > 0:
            w[0] += np.log(THRESHOLD / (1 - THRESHOLD)) - max(no_gain, scores[int(FALSE_ALARMS * len(scores))]) - 1e-6
        self.weights = w

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -30, 30)))


@dataclass
class _Segments:
    """Keys of the segments of documents, in how many documents of each cell a segment is, and one place of each.

    A cell is a class and a fold of the documents. Documents of one class and signature count once: near
    copies of one text would make its rare words look telling.
    """

    count: np.ndarray
    documents: np.ndarray
    place: np.ndarray
    words: list[list[bytes]]

    def text(self, i: int) -> bytes:
        doc, start, span = self.place[i].tolist()
        if span:
            return b" %b " % b" ".join(self.words[doc][start : start + span])
        return b" " + self.words[doc][start][:STEM]


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


def _keys(words: list[bytes], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and places (first word, words; 0 words: the beginning of one) of the distinct segments of a text."""
    at = [np.fromiter((number.setdefault(part, len(number)) for part in parts), np.uint64, len(words))
          for parts in (words, (b" " + w[:STEM] for w in words))]
    span = {1: _mixed(at[0] + np.uint64(1))}
    for left, right in SPANS:
        first, then = span[left][: len(words) - left - right + 1], span[right][left:]
        span[left + right] = _mixed(first[: len(then)] * np.uint64(0xD6E8FEB86659FD93) + then)
    found = [(0, _mixed(at[1] + np.uint64(1))), *span.items()]
    keys = np.concatenate([k for _, k in found])
    place = np.concatenate([np.stack([np.arange(len(k)), np.full(len(k), w)], axis=1) for w, k in found])
    keys, first = np.unique(keys, return_index=True)
    return keys, place[first]


def _segments(words: list[list[bytes]], cell: np.ndarray, cells: int, sure: float = SURE) -> _Segments:
    number: dict[bytes, int] = {}
    seen, single = set(), []
    for i, own in enumerate(words):
        signature = (_signature(own), int(cell[i]) * 2 // cells) if own else None
        if signature is not None and signature not in seen:
            seen.add(signature)
            single.append(i)
    # By key hash, in how many documents a segment is at most: most segments are rare, and are not kept.
    at_most = np.zeros(1 << _HASH_BITS, dtype=np.uint16)
    for i in single:
        at_most[np.unique(_keys(words[i], number)[0] >> np.uint64(64 - _HASH_BITS))] += 1
    keys, places = [np.zeros(0, np.uint64)], [np.zeros((0, 3), np.int32)]
    for i in single:
        key, place = _keys(words[i], number)
        often = at_most[key >> np.uint64(64 - _HASH_BITS)] > sure**2
        keys.append(key[often])
        places.append(np.insert(place[often], 0, i, axis=1).astype(np.int32))
    of = cell[single]
    key, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    code = inverse * cells + np.repeat(of, [len(k) for k in keys[1:]])
    count = np.bincount(code, minlength=len(key) * cells).reshape(-1, cells)
    often = count.sum(axis=1) > sure**2  # others are not told from chance
    return _Segments(count[often], np.bincount(of, minlength=cells), np.concatenate(places)[first[often]], words)


def _content(segments: _Segments, worth: np.ndarray, size: int) -> bytes:
    """The segments of the greatest worth times bytes saved, up to `size` bytes; the best last, where a match costs
    least. A segment within one that is already there is not repeated."""
    some = np.flatnonzero(worth > 0)
    texts = [segments.text(i) for i in some]
    order = sorted(range(len(some)), key=lambda j: (-worth[some[j]] * max(0, len(texts[j]) - MATCH), texts[j]))
    content = b""
    for j in order:
        if len(content) + len(texts[j]) > size:
            break
        if texts[j] not in content:
            content = texts[j] + content
    return content


def _resembling(segments: _Segments, some: np.ndarray, content: bytes) -> np.ndarray:
    """Which of `some` are words that a part of `content` could stand for, as they have as many bytes in common as a
    match takes."""
    parts = {content[i : i + LEAST_MATCH] for i in range(len(content) - LEAST_MATCH + 1)}
    found = np.zeros(len(some), dtype=bool)
    for i in np.flatnonzero(some & (segments.place[:, 2] == 1)):
        word = segments.text(i)
        found[i] = any(word[j : j + LEAST_MATCH] in parts for j in range(len(word) - LEAST_MATCH + 1))
    return found


def _dictionaries(segments: _Segments, use: np.ndarray, sure: float = SURE) -> CompressionScore:
    """Dictionaries of the documents of the cells in `use`, an array of (class, fold).

    A segment of a class is worth the bytes that it saves in a document of that class, less those that it saves in
    the other one. The first are taken at their least and the others at their most, so that chance finds save nothing.
    """
    count = (segments.count.reshape(-1, *use.shape) * use).sum(axis=2)
    documents = (segments.documents.reshape(use.shape) * use).sum(axis=1)
    least = (count - sure * np.sqrt(count)) / np.maximum(1, documents)
    most = (count + sure * np.sqrt(count) + sure) / np.maximum(1, documents)
    own = [_content(segments, least[:, c] - OTHER * most[:, 1 - c], OWN_BYTES) for c in (0, 1)]
    ordinary, toxic = own if documents.all() else (b"", b"")
    rate = count[:, 0] / max(1, documents[0])
    like = _content(segments, rate * _resembling(segments, rate > 0, toxic), LIKE_BYTES)
    return CompressionScore(_content(segments, rate, COMMON_BYTES) + like, toxic, ordinary)


def train(texts: Sequence[str], toxic: Sequence[int]) -> CompressionScore:
    """Dictionaries from all texts. The curve is fitted to features of texts that the dictionaries did not see: each
    fold of the texts under dictionaries of the others. Where so few texts teach that nothing is told from chance, and all
    would score alike, the evidence asked for is LESS_SURE; the curve is fitted to unseen texts then too."""
    model = _trained(texts, toxic, SURE)
    return model if np.abs(model.weights[1:]).max() > 0 else _trained(texts, toxic, LESS_SURE)


def _trained(texts: Sequence[str], toxic: Sequence[int], sure: float) -> CompressionScore:
    order = sorted(range(len(texts)), key=lambda i: (toxic[i], texts[i]))
    label = np.array([int(bool(toxic[i])) for i in order], dtype=int)
    fold = np.arange(len(order)) % FOLDS
    segments = _segments([words_of(texts[i]) for i in order], label * FOLDS + fold, 2 * FOLDS, sure)
    features = np.zeros((len(order), 4))
    for f in range(FOLDS):
        own = np.flatnonzero(fold == f)
        use = np.ones((2, FOLDS), dtype=int)
        use[:, f] = 0
        features[own] = _dictionaries(segments, use, sure).features([texts[order[i]] for i in own])
    model = _dictionaries(segments, np.ones((2, FOLDS), dtype=int), sure)
    model.calibrate(features, label)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    rows: tuple[int, int] = (FIT_TOXIC, FIT_ORDINARY),
    chars: int = FIT_CHARS,
) -> CompressionScore:
    """A model from about rows[0] toxic and rows[1] ordinary documents. A longer text than `chars` characters teaches by
    FIT_PIECES pieces from all over it that add up to `chars`.

    Null and empty texts and null ids teach nothing; a repeated row or copy counts once. No row gives a model that scores
    every text alike. Labels that are null are passed over; where a document has several, toxic wins. The ids are drawn first, by hash;
    their number is bounded, so they are broadcast to the scan of the texts.
    """
    named = (
        labels.filter(F.col(toxic).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("__id"))
        .agg(F.max((F.col(toxic) == 1).cast("int")).alias("__toxic"))
    )
    count = {r["__toxic"]: r["n"] for r in named.groupBy("__toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("__toxic") == 1, min(1.0, rows[0] / max(1, count.get(1, 0)))).otherwise(
        min(1.0, rows[1] / max(1, count.get(0, 0)))
    )
    drawn = named.filter(hash_fraction(["__id"], "toxic") < share)
    size = chars // FIT_PIECES
    step = ((F.length(text) - size) / (FIT_PIECES - 1)).cast("int")
    pieces = F.concat_ws(" ", *(F.substring(F.col(text), step * i + 1, F.lit(size)) for i in range(FIT_PIECES)))
    read = (
        docs.filter(F.length(text) > 0)
        .join(F.broadcast(drawn), F.col(id_column) == F.col("__id"))
        .select(F.when(F.length(text) <= chars, F.col(text)).otherwise(pieces).alias("text"), "__toxic")
    )
    found = sorted((r["text"], r["__toxic"]) for r in read.toLocalIterator())
    return train([t for t, _ in found], [y for _, y in found])


def toxicity(model: CompressionScore, docs: DataFrame, text: str = "text") -> Column:
    """Score of the whole text of each row, from 0 to 1. Null, empty and wordless texts get the score of no gain.

    Every window of a text of any length is compressed. Equal texts get equal scores; an empty table gives no row. Only
    the column `text` is read, so other columns may have any name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(sent.value.score(texts.tolist()))

    return F.pandas_udf(scored, T.DoubleType())(F.col(text))
