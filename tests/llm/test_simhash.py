import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tideline.llm import simhash
from tideline.llm.components import components


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    pieces = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest position reachable by steps of at most 2 bits."""
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(prints))]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("text", [None, "", "\x1c", "One", "one TWO", "a B c", "É é A b c d " * 40, "x\ty\nz\x0bw\x0cv\rU"])
def test_fingerprint(text):
    assert simhash.fingerprint_of(None if text is None else text.encode()) % (1 << 64) == brute_fingerprint(text)


def test_components_against_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcde", k=5)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)]
    for t in texts[:20]:
        parts = t.split()
        for k in range(rng.randint(0, 6)):
            if parts:
                parts[k % len(parts)] = rng.choice(words)
            texts.append(" ".join(parts))
    texts += [None, "", " ", texts[0], texts[0]]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, fp int")
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    roots = brute_components(prints)
    for i, r in found.items():
        assert (r["fp"], r["component_id"]) == (signed(prints[i]), roots[i])
    kept = simhash.one_of_each(docs.unionByName(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots))
    assert kept.columns == docs.columns


@pytest.mark.parametrize("bucket", [2, 64])
def test_crowded_buckets_lose_no_link(spark, monkeypatch, bucket):
    """A dense cloud of fingerprints, and chains whose ends are far apart; small buckets go through points."""
    monkeypatch.setattr(simhash, "PAIR_BUCKET", bucket)
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    chain = rng.getrandbits(64)
    for _ in range(25):
        chain ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
        prints.add(chain)
    prints |= {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1}
    prints = sorted(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.fingerprint_links(frame)).collect()}
    groups = {}
    for p, root in zip(prints, brute_components(prints), strict=True):
        groups.setdefault(root, set()).add(signed(p))
    found = {}
    for p in prints:
        found.setdefault(roots.get(signed(p), signed(p)), set()).add(signed(p))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    docs = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, "x y z w"), (None, "x y z w")], empty.schema)
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in found) == [(0, 0), (0, 0), (0, 4), (4, 4)]


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    loop = spark.createDataFrame([(500, 500)], "a long, b long")
    assert {(r["node"], r["root"]) for r in components(links.union(loop)).collect()} == {(i, 0) for i in range(200)}
