import hashlib
import zlib
from itertools import pairwise

import numpy as np
import pytest

from tideline.llm import sharding

SCHEMA = "doc_id long, text string"


def brute_capacity(sizes, shards):
    """Least possible greatest sum over all ways to cut, by dynamic programming."""
    ends = np.r_[0, np.cumsum(sizes)]
    best = ends.astype(float)
    for _ in range(shards - 1):
        best = np.array([min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))])
    return int(best[-1])


def documents(n, hot=0):
    texts = ["t" * (i * 37 % 101) + str(i % 90) for i in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(10_000 + i, "hot text " * 5) for i in range(hot)]


@pytest.mark.parametrize(("n", "hot"), [(300, 0), (200, 150), (3, 0)])
def test_minimax_groups_and_slots(spark, n, hot):
    data = documents(n, hot)
    found = sharding.shard_documents(spark.createDataFrame(data, SCHEMA)).collect()
    texts = dict(data)
    assert len(found) == len(data)
    groups = {}
    for i, t in data:
        groups[t] = groups.get(t, 0) + len(t.encode()) + 1
    order = sorted(groups, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    load, of_text, slots = [0] * 8, {}, {}
    for r in found:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        load[r["shard"]] += r["size"]
        of_text.setdefault(text, set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    shards = [min(of_text[t]) for t in order]
    assert all(b - a in (0, 1) or a < b for a, b in pairwise(shards))
    assert max(load) == brute_capacity([groups[t] for t in order], 8)


def test_nulls_repeats_and_clashing_columns(spark):
    data = [(1, None, 5, "x"), (None, "", 6, "y"), (2, "", 7, "z"), (2, "", 7, "z"), (3, "long " * 50_000, 8, "w")]
    docs = spark.createDataFrame(data, "doc_id long, text string, shard int, `__key` string")
    found = sharding.shard_documents(docs).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in found)[:4] == [(1, 0)] * 4
    assert len(found) == 5
    assert len({r["shard"] for r in found if r["doc_id"] in (None, 2)}) == 1
    assert sharding.shard_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_refined_summary_finds_the_exact_capacity(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 50, rng.integers(1, 40))
    if seed % 3 == 0:
        sizes[rng.integers(len(sizes))] = 1000
    single = np.ones(len(sizes), bool)
    assert sharding.smallest_capacity(sizes, single, 5) == brute_capacity(sizes, 5)


@pytest.mark.parametrize("seed", range(30))
def test_even_cuts_keep_the_capacity(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 50, rng.integers(1, 60))
    if seed % 3 == 0:
        sizes[rng.integers(len(sizes))] = 1000
    capacity = sharding.smallest_capacity(sizes, np.ones(len(sizes), bool), 8)
    cuts = sharding.even_cuts(sizes, capacity, 8)
    assert cuts[-1] == sizes.sum() and max(np.diff([0, *cuts])) == capacity == brute_capacity(sizes, 8)
    assert set(cuts) <= {0, *np.cumsum(sizes).tolist()}


@pytest.mark.parametrize("place", [0, 40, 100])
def test_no_shard_is_empty_beside_a_heavy_group(place):
    sizes = np.full(101, 7)
    sizes[place] = 300
    loads = np.diff([0, *sharding.even_cuts(sizes, 300, 8)])
    assert loads.max() == 300 and loads.min() >= 80
