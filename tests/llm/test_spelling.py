import random
import re
import zlib
from collections import Counter

import pytest

from tideline.llm import spelling
from tideline.llm.spelling import PositionIndex

SCHEMA = "doc_id long, text string"
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, size = {}, {}
    for w in words:
        around = [v for v in words if near(w, v)]
        size[w] = len(around)
        best = min(around, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, size[w], words.get(form[w])) for w, n in words.items())


def found(df):
    return sorted(tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())


def planted():
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdéÉ", k=rng.randint(5, 9))) for _ in range(120)]
    texts = []
    for k in range(400):
        words = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.05)), 119)]
            if rng.random() < 0.5:
                at, c = rng.randrange(len(w)), rng.choice("abcdé÷")
                w = rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        texts.append((k if k % 50 else None, rng.choice([" ", "-", "1"]).join(words)))
    chain = [("tablet", 6), ("tabler", 40), ("tabbler", 300), ("tabblers", 1600)]
    return texts + [(1000, " ".join(w for w, n in chain for _ in range(n))), (1001, None), (1002, ""), (1003, "short wo"), *([(1004, "again again")] * 3)]


@pytest.mark.parametrize("index_words", [2048, 5])
def test_against_brute_force(spark, monkeypatch, index_words):
    """Also with groups dealt to indexes of a few words each."""
    monkeypatch.setattr(spelling, "INDEX_WORDS", index_words)
    rows = planted()
    expected = brute_force(rows)
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] and r[1] != r[2] for r in expected)


def test_index_finds_one_error_only():
    rng = random.Random(0)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(900)})
    index = PositionIndex(words)
    for query in rng.sample(words, 200) + ["x", "abcabcabcabc", "aaaaaaaa"]:
        bits = index.near(query)
        assert [w for i, w in enumerate(words) if bits >> i & 1] == [w for w in words if near(w, query)]
        cut = index.near(query, apart_before=2)
        assert [w for i, w in enumerate(words) if cut >> i & 1] == [w for w in words if near(w, query) and (len(query) <= 2 or w[:2] != query[:2])]


def test_empty_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    rows = [(k, "wordone wordone wordtwo wordtwa " * 3) for k in range(4)]
    extra = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", n long, word string, run long")
    assert found(extra) == brute_force(rows)
    long = [(7, "lengthy lengthi " * 40_000 + "lenghty")]
    assert found(spark.createDataFrame(long, SCHEMA)) == brute_force(long)
