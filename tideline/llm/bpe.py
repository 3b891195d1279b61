"""Byte-level BPE: words of a text as rows of numpy matrices that merge one pair each per round."""

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideline.llm.common import HashIndex

#: Rows longer than this are merged one by one.
LONGEST_ROW = 512
#: Words whose ids a task remembers, and bytes of text it works on at once.
REMEMBERED_WORDS, TEXT_BLOCK = 100_000, 1 << 19
_NONE = np.int32(2**31 - 1)
_NO_IDS = np.zeros(0, np.int32)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairs:
    """Encoder and decoder of a rank file in which every single byte is a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        keys, ids = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ids.append(rank)
        self._pairs = HashIndex(np.array(keys, dtype=np.uint64))
        self._merged = np.append(np.array(ids, dtype=np.int32), _NONE)  # the last is what -1 finds
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._start = np.cumsum(self._length) - self._length
        self._bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where the pair is no token or an end is padding (-1)."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).astype(np.uint64)
        found = self._merged[self._pairs.find(keys.ravel())].reshape(keys.shape)
        return np.where((left < 0) | (right < 0), _NONE, found)

    def _merge_rows(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, ids padded with -1) of rows as they are done.

        Each round merges every row's leftmost pair of least rank. Rows without a pair leave; in the others one
        column goes, so the matrix stays dense.
        """
        rows, out = np.arange(len(ids)), []
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        while len(ids):
            width = ids.shape[1]
            at = rank.argmin(axis=1) if width > 1 else np.zeros(len(ids), np.int64)
            best = rank[np.arange(len(ids)), at] if width > 1 else np.full(len(ids), _NONE)
            going = best < _NONE
            if not going.all():
                out.append((rows[~going], ids[~going]))
                rows, ids, rank, at, best = rows[going], ids[going], rank[going], at[going], best[going]
            n = len(ids)
            if not n:
                break
            every = np.arange(n)
            ids[every, at] = best
            keep = np.ones((n, width), dtype=bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), dtype=bool)
            keep[every, at] = False
            rank = rank[keep].reshape(n, width - 2)
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self._rank(ids[before, at[before] - 1], best[before])
            after = np.flatnonzero(at < width - 2)
            rank[after, at[after]] = self._rank(best[after], ids[after, at[after] + 1])
        return out

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: merged places are marked, and taken out when half are."""
        ids = ids.copy()
        while len(ids) > 1:
            n = len(ids)
            rank = np.append(self._rank(ids[:-1], ids[1:]), _NONE)
            after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
            alive = np.ones(n, dtype=bool)
            for gone in range(n):
                at = int(rank.argmin())
                best = rank[at]
                if best == _NONE or gone > n // 2:
                    break
                right = after[at]
                ids[at], alive[right], rank[right] = best, False, _NONE
                after[at] = after[right]
                if after[at] < n:
                    before[after[at]] = at
                    rank[at] = self._rank(ids[at : at + 1], ids[after[at]][None])[0]
                else:
                    rank[at] = _NONE
                if before[at] >= 0:
                    rank[before[at]] = self._rank(ids[before[at]][None], ids[at : at + 1])[0]
            ids = ids[alive]
            if best == _NONE:
                break
        return ids

    def encode_words(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each word has."""
        found: list[np.ndarray | None] = [None] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            known = self.ranks.get(word)
            if known is not None:
                found[i] = np.array([known], np.int32)
            elif len(word) > LONGEST_ROW:
                found[i] = self._merge_long(self._byte[np.frombuffer(word, np.uint8)])
            else:
                by_width.setdefault(len(word) if len(word) <= 16 else 1 << (len(word) - 1).bit_length(), []).append(i)
        for width, at in by_width.items():
            for block in range(0, len(at), max(1, (1 << 21) // width)):
                some = at[block : block + max(1, (1 << 21) // width)]
                length = np.fromiter((len(words[i]) for i in some), np.int64, len(some))
                ids = np.full((len(some), width), -1, np.int32)
                ids[np.arange(width) < length[:, None]] = self._byte[np.frombuffer(b"".join(words[i] for i in some), np.uint8)]
                for rows, merged in self._merge_rows(ids):
                    size = (merged >= 0).sum(axis=1)
                    for row, piece in zip(rows.tolist(), np.split(merged[merged >= 0], np.cumsum(size)[:-1]), strict=True):
                        found[some[row]] = piece
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate(found) if found else np.zeros(0, np.int32), count

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens. An id that no token has raises ValueError."""
        ids = np.asarray(ids, dtype=np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._length) or not self._length[ids].all()):
            raise ValueError("an id that no token has")
        return self._bytes[_ranges(self._start[ids], self._length[ids])].tobytes()


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each start, one after the other."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


class WordMemory:
    """Encodes texts word by word; words met before are looked up. Forgets all when it holds too many."""

    def __init__(self, pairs: BytePairs, pattern: str):
        self._pairs, self._find = pairs, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        self._ids, self._count = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        words = [self._find(text) for text in texts]
        flat = [w for ws in words for w in ws]
        if len(self._number) > REMEMBERED_WORDS:
            self._forget()
        new = list(dict.fromkeys(w for w in set(flat) if w not in self._number))
        if new:
            ids, count = self._pairs.encode_words([w.encode("utf-8", "surrogatepass") for w in new])
            self._number.update(zip(new, range(len(self._number), len(self._number) + len(new)), strict=True))
            self._ids, self._count = np.concatenate([self._ids, ids]), np.concatenate([self._count, count])
        start = np.cumsum(self._count) - self._count
        at = np.fromiter(map(self._number.__getitem__, flat), np.int64, len(flat))
        ids = self._ids[_ranges(start[at], self._count[at])]
        ends = np.r_[0, np.cumsum(self._count[at])][np.cumsum([len(ws) for ws in words])] if words else []
        return np.split(ids, ends[:-1]) if len(ends) else []


@lru_cache(maxsize=2)
def _pairs_of(name: str, broadcast) -> BytePairs:
    return BytePairs(broadcast.value)


class _Ranks:
    """The rank file's content, sent to the executors once. Vocabulary files are bounded: some MB."""

    def __init__(self, path: str):
        self.name = path
        self.broadcast = SparkContext.getOrCreate().broadcast(read_ranks(path))

    def pairs(self) -> BytePairs:
        return _pairs_of(self.name, self.broadcast)

    def __getstate__(self):
        return {"name": self.name, "broadcast": self.broadcast}


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of rows of about `most` in all; a larger row stands alone."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(ends, most + (ends[at - 1] if at else 0), side="right")))
        yield at, end
        at = end


def encode(docs: DataFrame, text: str, rank_file: str, pattern: str, tokens: str = "tokens") -> DataFrame:
    """`docs` with the column `tokens` in place of `text`: the ids of the whole text as array<int>.

    Each match of `pattern` is encoded by itself, without special tokens. A null or empty text has no tokens. Other
    columns and repeated rows stay as they are; an empty table stays empty. A column that is already called `tokens`
    is replaced.
    """
    ranks = _Ranks(rank_file)
    rest = [c for c in docs.columns if c not in (text, tokens)]
    rows = docs.select(*rest, text)
    schema = T.StructType([*(rows.schema[c] for c in rest), T.StructField(tokens, T.ArrayType(T.IntegerType(), False))])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(ranks.pairs(), pattern)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(len(rest))), 0).to_numpy(zero_copy_only=False)
            for start, end in _blocks(size, TEXT_BLOCK):
                part = batch.slice(start, end - start)
                ids = memory.encode([t or "" for t in part.column(len(rest)).to_pylist()])
                offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], column], names=[*rest, tokens])

    return rows.mapInArrow(encoded, schema)


def decode(
    docs: DataFrame, rank_file: str, tokens: str = "tokens", text: str = "decoded", packed: str | None = None
) -> DataFrame:
    """Adds the bytes that the ids stand for as a binary column `text`; null ids give no bytes, unknown ids an error.

    Bytes, not text: ids cut from a longer run may end within a character. `packed`, if named, is added too: the ids as
    little-endian unsigned 32-bit integers. Columns that already have these names are replaced.
    """
    ranks = _Ranks(rank_file)
    added = [text, packed] if packed else [text]
    rest = [c for c in docs.columns if c not in added]
    rows = docs.select(*rest)
    schema = T.StructType([*rows.schema, *(T.StructField(name, T.BinaryType()) for name in added)])
    at = rest.index(tokens)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ranks.pairs()
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for start, end in _blocks(size, TEXT_BLOCK):
                part = batch.slice(start, end - start)
                ids = [_NO_IDS if x.values is None else x.values.to_numpy() for x in part.column(at)]
                out = [pa.array(map(pairs.decode, ids), pa.binary())]
                if packed:
                    out.append(pa.array((x.astype("<u4").tobytes() for x in ids), pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=[*rest, *added])

    return rows.mapInArrow(decoded, schema)
