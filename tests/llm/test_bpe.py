import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tideline.llm import bpe

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANK_FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pairs():
    return bpe.BytePairs(bpe.read_ranks(RANK_FILE))


TEXTS = [
    None,
    "",
    " ",
    "Hello world, it's 2024!  \n\n  x",
    "<|endoftext|> is ordinary",
    "ñandú Ärger ça 漢字 🙂🙂 é",
    "a" * 3000,
    "ab" * 2000 + "!" * 1500,
    " " * 4000 + "x",
    "\u0000\u001f​",
    "word " * 30_000,
]


def test_texts_against_the_library(spark, reference):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, tokens int, decoded string")
    found = bpe.decode(bpe.encode(docs, "text", RANK_FILE, public_tokenizers.PATTERN), RANK_FILE)
    assert found.columns == ["doc_id", "tokens", "decoded"] or set(found.columns) == {"doc_id", "tokens", "decoded"}
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        assert r["tokens"] == reference.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()


def test_random_words_against_the_library(pairs, reference):
    rng = random.Random(1)
    words = [bytes(rng.choices(range(256), k=rng.randint(1, 40))) for _ in range(500)]
    words += ["".join(rng.choices("abenrst ", k=rng.randint(1, 700))).encode() for _ in range(300)]
    ids, count = pairs.encode_words(words)
    at = 0
    for word, n in zip(words, count.tolist(), strict=True):
        assert ids[at : at + n].tolist() == reference._core_bpe.encode_single_piece(word)
        assert pairs.decode(ids[at : at + n]) == word
        at += n
    assert pairs.encode_words([])[0].size == 0


def test_long_rows_agree_with_short_ones(pairs, monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choices("abenrst", k=200)).encode() for _ in range(30)]
    short = pairs.encode_words(words)
    monkeypatch.setattr(bpe, "LONGEST_ROW", 10)
    long = pairs.encode_words(words)
    assert all((a == b).all() for a, b in zip(short, long, strict=True))


def test_unknown_ids_and_digests(spark, pairs):
    with pytest.raises(ValueError):
        pairs.decode([50256])
    rows = spark.createDataFrame([([1, 50000],), ([],), (None,)], "tokens array<int>")
    found = [bytes(r["decoded"]) for r in bpe.decode(rows, RANK_FILE, packed="p").select(F.col("p").alias("decoded")).collect()]
    assert found == [b"\x01\0\0\0\x50\xc3\0\0", b"", b""]
    assert hashlib.sha256(found[1]).hexdigest().startswith("e3b0c442")
    assert [bytes(r["decoded"]) for r in bpe.decode(rows.limit(0), RANK_FILE).collect()] == []


def test_memory_forgets(pairs, monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 5)
    memory = bpe.WordMemory(pairs, public_tokenizers.PATTERN)
    for text in ["one two three four five six seven", "eight nine one two", "", "ten six"]:
        assert memory.encode([text])[0].tolist() == reference.encode_ordinary(text)
    assert memory.encode([]) == []
