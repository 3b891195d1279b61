import re

import pytest
from pyspark.sql import functions as F

from tideline.llm import mixing

SCHEMA = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, share=1.5, most=2.0):
    """Fill by weight and reshare what is above the cap until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / total for s in open_}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


def rows_of(spark, n=300):
    texts = [" ".join(["w"] * (i * 7 % 23)) for i in range(n)]
    rows = [(i, texts[i], ["a", "b", None, "ä", "B"][i % 5] if i % 3 else "a") for i in range(n)]
    return spark.createDataFrame([*rows, (0, texts[0], "a"), (None, "x y", "b"), (7, None, "b"), (n + 1, "\x1f z q", "c")], SCHEMA)


def test_targets_and_exact_cuts(spark):
    docs = rows_of(spark)
    found = mixing.mix(docs, keep=["text", "source"]).collect()
    assert len(found) == docs.count()
    sizes = {}
    for r in found:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = brute_targets(sizes)
    taken = {s: 0 for s in sizes}
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert taken == {s: int(targets[s] + 1e-9) for s in sizes}


def test_any_partitioning_agrees(spark, rows):
    docs = rows_of(spark)
    assert rows(mixing.mix(docs.repartition(1))) == rows(mixing.mix(docs.repartition(7)))


def test_mixed_documents_hold_the_words_taken(spark):
    docs = rows_of(spark).withColumn("taken", F.lit("clash")).withColumn("size", F.lit(1))
    plan = {}
    for r in mixing.mix(docs).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["taken"]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words, originals = {}, {r["doc_id"]: r["text"] for r in docs.collect() if r["text"]}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
        assert r["doc_id"] in (0, None) or originals[r["doc_id"]].startswith(r["text"])
    assert words == {k: v for k, v in plan.items() if v}


def test_empty_table_and_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    found = mixing.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in found) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
