import numpy as np
import pytest

from tideline.llm import embedding_dedup, neighbours
from tideline.llm.embedding_dedup import Codes
from tideline.llm.neighbours import Hashing

SCHEMA = "vec_id long, embedding array<float>"
ODD = [(900, None), (901, []), (902, [0.0, 0.0, 0.0, 0.0]), (903, [1.0, None, 0.0, 0.0]), (904, [float("nan"), 1.0, 0.0, 0.0]),
       (905, [float("inf"), 1.0, 0.0, 0.0]), (950, [1.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0])]


def cosine(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def clouds(seed, groups, each, d=64, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, d))
    x = np.repeat(centres, each, axis=0) + spread * rng.standard_normal((groups * each, d))
    return x.astype(np.float32)


def test_search_by_hand(spark):
    rows = [(0, [1.0, 0, 0, 0]), (1, [2.0, 0, 0, 0]), (2, [1.0, 1.0, 0, 0]), (3, [1.0, 1.0, 0, 0]), (4, [0, 0, 0, 1e-30]),
            (50, [0, 0, 1.0, 1e30]), (2, [1.0, 1.0, 0, 0]), *ODD]
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA + ", score int")
    found = neighbours.search(table, table.filter("vec_id % 50 = 0"), k=3, hashing=Hashing(width=50.0))
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 6)))
    half = round(0.5**0.5, 6)
    assert got[0] == [(1, 1, 1.0), (2, 2, half), (3, 3, half)]
    assert [x[1] for x in got[50]] == [4, 0, 1]
    assert 900 not in got and 950 not in got


def test_search_recall(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    table = spark.read.parquet(path)
    data = {r["vec_id"]: r["embedding"] for r in table.collect()}
    ids = sorted(data)
    x = np.array([data[i] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = neighbours.search(table, table.filter("vec_id % 50 = 0")).collect()
    hits = 0
    for q in [i for i in ids if i % 50 == 0]:
        score = x @ x[ids.index(q)]
        score[ids.index(q)] = -2
        true = {ids[j] for j in np.lexsort((ids, -score))[:5]}
        own = [r for r in found if r["query_id"] == q]
        assert [r["rank"] for r in sorted(own, key=lambda r: (-r["score"], r["vec_id"]))] == [1, 2, 3, 4, 5]
        assert all(abs(r["score"] - cosine(data[q], data[r["vec_id"]])) < 1e-12 for r in own)
        hits += len(true & {r["vec_id"] for r in own})
    assert hits >= 0.9 * 5 * len([i for i in ids if i % 50 == 0])


def test_probes_go_from_near_to_far():
    hashing = Hashing(functions=3, probes=20)
    rows = hashing.perturbations()
    assert rows[0].sum() == 0 and rows[1].tolist() == [1, 0, 0, 0, 0, 0]
    assert not any(row[j] and row[5 - j] for row in rows for j in range(3))
    assert len({tuple(r) for r in rows}) == len(rows)


def test_blocks_do_not_change_the_result(spark, monkeypatch, rows):
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(clouds(1, 30, 4))], SCHEMA)
    whole = rows(neighbours.search(table, table.filter("vec_id % 5 = 0")))
    monkeypatch.setattr(neighbours, "INDEX_BLOCK", 20)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    monkeypatch.setattr(neighbours, "_AT_ONCE", 50)
    assert rows(neighbours.search(table, table.filter("vec_id % 5 = 0"))) == whole


def test_search_in_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)
    assert neighbours.search(empty, empty).collect() == neighbours.search(one, empty).collect() == []
    assert neighbours.search(one, one).collect() == []


def brute_dedup(data, threshold=0.9):
    ids = list(range(len(data)))
    n, root = [0] * len(ids), list(ids)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in ids:
        for b in range(a):
            if data[a] is not None and data[b] is not None and cosine(data[a], data[b]) >= threshold:
                n[a] += 1
                n[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(i, n[i], find(i), find(i) == i) for i in ids]


@pytest.mark.parametrize("part", [2048, 5])
def test_dedup_against_brute_force(spark, monkeypatch, part):
    """Also with crowded buckets dealt to parts of a few rows, and small chunks."""
    monkeypatch.setattr(embedding_dedup, "PART_ROWS", part)
    monkeypatch.setattr(embedding_dedup, "CHUNK_ROWS", 64 if part == 5 else 1 << 14)
    x = list(clouds(2, 12, 9)) + [clouds(2, 12, 9)[0]] * 5 + list(clouds(8, 20, 1))
    chain = np.zeros((6, 64), np.float32)
    for i in range(6):
        chain[i, :2] = np.cos(0.4 * i), np.sin(0.4 * i)
    x = [v.tolist() for v in [*x, *chain, 3 * chain[2]]]
    table = spark.createDataFrame([(i, v, 9) for i, v in enumerate(x)], SCHEMA + ", n_links int")
    found = embedding_dedup.near_duplicates(table).collect()
    assert sorted(tuple(r) for r in found) == brute_dedup(x)


def test_dedup_of_odd_vectors(spark):
    rows = [*ODD[:6], (1, [1.0, 0.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0, 0.0]), (7, [2.0, 0.0, 0.0, 0.0]), (8, [2.0, 0.0])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    alone = [(i, 0, i, True) for i in (900, 901, 902, 903, 904, 905, 8)]
    assert sorted(tuple(r) for r in found) == sorted([*alone, (1, 2, 1, True), (1, 2, 1, True), (7, 2, 1, False)])
    nulls = embedding_dedup.near_duplicates(spark.createDataFrame([(None, [1.0]), (None, None)], SCHEMA)).collect()
    assert [tuple(r) for r in nulls] == [(None, 0, None, False)] * 2
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal(64), rng.standard_normal(64)
    b = a + 0.8 * b
    a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
    errors, inside = [], 0
    for seed in range(300):
        codes = Codes(seed=seed, bits=16, tables=4)
        packed, factors = embedding_dedup.encode(codes, a[None])
        guess, bound = embedding_dedup.estimators(codes, packed, factors, 64)
        errors.append(float(guess[0] @ b) - float(a @ b))
        inside += abs(errors[-1]) <= bound[0]
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(len(errors))
    assert inside >= 299


@pytest.mark.parametrize("kind", ["float", "double"])
def test_dedup_finds_links_just_above_the_threshold(spark, kind):
    """Planted pairs at cosines of 0.90 to 0.92."""
    rng = np.random.default_rng(4)
    data = []
    for at in np.linspace(0.9001, 0.92, 600):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        data += [a, at * a + np.sqrt(1 - at**2) * b / np.linalg.norm(b)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], f"vec_id long, embedding array<{kind}>")
    found = embedding_dedup.near_duplicates(table).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(i, 1, i // 2 * 2) for i in range(1200)]
