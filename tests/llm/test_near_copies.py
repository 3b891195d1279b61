import random

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest

from tideline.llm import near_copies, simhash
from tideline.llm.near_copies import Likeness

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_components(rows):
    """Smallest id reachable by steps between texts of similarity 0.8 or more; blank texts are one class."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(i, rows[find(k)][0]) for k, (i, _) in enumerate(rows)]


def planted():
    """Documents with a common line, copies with scattered edits about the threshold, chains, a crowd and odd texts."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    texts = [rng.choices(words, k=rng.randint(1, 300)) for _ in range(60)]
    line = rng.choices(words, k=30)
    texts += [line + rng.choices(words, k=100) for _ in range(40)]
    for base in [*texts[:25], texts[70]]:
        now = base
        for _ in range(4):
            now = [rng.choice(words) if rng.random() < 0.02 else w for w in now]
            texts.append(now)
    crowd = rng.choices(words, k=200)
    for _ in range(40):
        edited = list(crowd)
        edited[rng.randrange(200)] = rng.choice(words)
        texts.append(edited)
    rows = [" ".join(t) for t in texts] + [None, "", " \t ", "one", "ONE", "one two", "1", rows_twice := " ".join(texts[3]), rows_twice]
    return list(enumerate(rows))


@pytest.mark.parametrize("part", [1024, 7])
def test_against_brute_force(spark, monkeypatch, part):
    """Also with crowded buckets dealt to parts of a few rows, small chunks and a small list of common shingles."""
    monkeypatch.setattr(near_copies, "PART_ROWS", part)
    monkeypatch.setattr(near_copies, "CHUNK_BYTES", 50_000 if part == 7 else 1 << 23)
    monkeypatch.setattr(near_copies, "COMMON_ROWS", 5 if part == 7 else 50_000)
    rows = planted()
    found = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in found) == brute_components(rows)


def test_vectors_rule_out_no_near_copies():
    """The bound leaves every pair of the similarity connected, and tears most of the others apart."""
    rng = np.random.default_rng(4)
    like, sets = Likeness(), []
    for size in (1, 5, 40, 300, 900, 5000):
        base = rng.integers(-(1 << 63), 1 << 63, size)
        for share in (0, 0.05, 0.1, 0.11, 0.12, 0.3, 1):
            changed = base.copy()
            changed[: int(share * size)] = rng.integers(-(1 << 63), 1 << 63, int(share * size))
            sets.append(np.unique(changed))
    sizes = np.array([len(s) for s in sets])
    left = near_copies._may_link(like, sizes, [near_copies.count_vector(s) for s in sets])
    root = list(range(len(sets)))
    for a, b in left:
        x, y = near_copies_root(root, a), near_copies_root(root, b)
        root[max(x, y)] = min(x, y)
    for a, b in near_copies._linked(like, sets):
        assert near_copies_root(root, a) == near_copies_root(root, b)
    assert len(left) < len(sets) - 6


def near_copies_root(root, a):
    while root[a] != a:
        a = root[a]
    return a


def test_prefixes_reach_the_threshold():
    for n in range(1, 400):
        assert Likeness().prefix(n) == n - (4 * n + 4) // 5 + 1
    assert Likeness().prefix(0) == 0


def test_stage_drops_copies_with_scattered_edits(spark):
    """Copies of similarity 0.8 to 0.9, of which the fingerprints of query 7 link hardly any."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    rows = []
    for i in range(50):
        base = rng.choices(words, k=200)
        copy = list(base)
        for at in (20, 80, 140, 180):
            copy[at] = "edited"
        assert 0.8 <= len(shingles(" ".join(base)) & shingles(" ".join(copy))) / len(shingles(" ".join(base)) | shingles(" ".join(copy))) < 0.9
        rows += [(2 * i, " ".join(base), "en", "a", 0), (2 * i + 1, " ".join(copy), "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.one_near_duplicate(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 100, 2))
    assert simhash.one_of_each(docs).count() > 75


def test_clashing_names(spark):
    rows = [(1, "a b c d e f g", "en", "a", 1), (2, "a b c d e f g", "en", "b", 1)]
    docs = spark.createDataFrame([(*r, 1, "x", 3) for r in rows], SCHEMA + ", c long, class string, least long")
    assert [tuple(r) for r in near_copies.one_of_each(docs).collect()] == [(*rows[0], 1, "x", 3)]


def test_empty_and_null_ids(spark):
    assert near_copies.one_of_each(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b c", "en", "a", 1), (None, "a b c", "en", "a", 1), (4, "d e f", "en", "a", 1), (4, "d e f", "en", "a", 1)]
    assert sorted(near_copies.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect(), key=str) == sorted(
        spark.createDataFrame([rows[0], rows[2]], SCHEMA).collect(), key=str
    )


def test_no_component_is_left_without_a_row(spark):
    """Ids that texts of several components share, and null ids, stay in each of them; a near copy stays in none."""
    words = [f"w{k}" for k in range(60)]
    near = [*words[:59], "other"]
    alone = [[f"{c}{k}" for k in range(9)] for c in "abcdef"]
    texts = [" ".join(t) for t in (words, near, *alone)]
    ids = [3, 5, 5, 5, None, None, 7, 7]
    rows = [(i, t, "en", "a", 0) for i, t in zip(ids, texts, strict=True)]
    rows += [(None, texts[4], "en", "b", 0), (None, texts[1], "en", "a", 0), (7, texts[6], "en", "a", 0)]
    kept = near_copies.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["text"] for r in kept) == sorted(texts[:1] + texts[2:])
    assert sorted(str(r["doc_id"]) for r in kept) == ["3", "5", "5", "7", "7", "None", "None"]


def test_fingerprints_give_candidates(spark, monkeypatch):
    """What fingerprints link is compared also where prefixes bring nothing together; only the similarity decides."""
    monkeypatch.setattr(near_copies, "_groups", lambda like, prefixes: prefixes.select("c", "c").toDF("g", "c").limit(0))
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    whole = rng.choices(words, k=2000)
    edited = [*whole[:900], "changed", *whole[901:]]
    other = rng.choices(words, k=2000)
    texts = [" ".join(t) for t in (whole, edited, other)]
    prints = [simhash.fingerprint_of(t.encode(), 5) for t in texts]
    assert 0 < (prints[0] ^ prints[1]).bit_count() <= simhash.DISTANCE < ((prints[0] ^ prints[2]) % (1 << 64)).bit_count()
    rows = [(i, t, None, None, 0) for i, t in enumerate([*texts, "one", "one two"], 1)]
    found = near_copies.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5)]


def test_pieces_are_bounded_and_whole():
    texts = [None, b"", b"x" * 5, b"y" * (3 * near_copies.PIECE_BYTES), None, *[b"z" * 300_000] * 9]
    batch = pd.DataFrame({"c": range(len(texts)), "text": texts}, index=range(7, 7 + len(texts)))
    found = list(near_copies.pieces(batch))
    assert [c for piece in found for c in piece["c"]] == list(range(len(texts)))
    assert all(len(p) == 1 or sum(len(x or b"") for x in p["text"]) <= near_copies.PIECE_BYTES for p in found if p["text"].notna().sum() > 1)
    assert len(found) > 3
    assert sum(map(len, near_copies.pieces(batch.iloc[:0]))) == 0
