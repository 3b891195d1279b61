import json

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.test_near_copies import brute_components
from tideline.llm import bpe, mixing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and made."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, SF).write.parquet(out)
        seen.append((name, docs, spark.read.parquet(out)))
        docs = seen[-1][2]
    return seen


def test_all_but_the_last_return_documents(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert dict(after.dtypes) == dict(before.dtypes)


def test_language_and_toxicity_keep_clean_documents(spark, stages):
    (_, all_docs, spoken), (_, _, civil) = stages[:2]
    lost = all_docs.select("doc_id").subtract(spoken.select("doc_id")).join(all_docs, "doc_id")
    assert lost.filter(F.col("text").rlike(r"\p{L}")).count() == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    dropped = spoken.select("doc_id").subtract(civil.select("doc_id")).join(labels, "doc_id")
    assert dropped.filter("toxic = 0").count() <= 0.02 * labels.count()


def test_one_of_each_group_stays(stages):
    """Against brute-force Jaccard similarities of five-word shingles."""
    _, before, after = stages[2]
    rows = sorted((r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect())
    least = {component for _, component in brute_components(rows)}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(least)


PLAIN = "the quiet river ran past the old mill and the children of the village went there to swim every summer"


def planted(spark, tmp_path):
    """Documents of the small table with toxic ones, copies and a near copy among them, written as the driver's are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = whole.join(labels.filter("toxic = 1"), "doc_id", "left_semi").limit(20)
    words = [f"{w}{k}" for k in range(20) for w in PLAIN.split()]
    edited = [*words[:100], "changed", *words[101:]]
    rows = [(10_000, " ".join(words)), (10_001, " ".join(words)), (10_002, " ".join(edited)), (10_003, "12 34"), (10_004, None)]
    more = spark.createDataFrame([(i, t, "en", "planted", 0) for i, t in rows], docs.schema)
    folder = str(tmp_path)
    docs.unionByName(toxic).unionByName(more).dropDuplicates(["doc_id"]).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder, {r["doc_id"] for r in toxic.collect()}


def test_run_on_planted_documents(spark, tmp_path):
    """run() chains the stages: most toxic documents go, copies and near copies leave one, the rest comes out encoded."""
    folder, toxic = planted(spark, tmp_path)
    out = corpus_pipeline.run(spark, folder)
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert not ids & {10_001, 10_002, 10_003, 10_004}
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 9000")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in toxic and r["text"])
    clean = {component for _, component in brute_components(rows)}
    assert len(ids & clean) >= 0.8 * len(clean) and len(toxic & ids) <= 0.5 * len(toxic)
    back = bpe.decode(out, corpus_pipeline.RANK_FILE).select("doc_id", F.col("decoded").cast("string").alias("text"))
    whole = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in back.collect():
        assert whole[r["doc_id"]].startswith(r["text"].rstrip())


def test_mixture_and_tokens(stages):
    (_, before, mixed), (_, _, tokens) = stages[3:]
    taken = mixing.mix(before).agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum(mixing.word_count("text"))).first()[0] == taken
    assert tokens.count() == mixed.count()
    back = bpe.decode(tokens, corpus_pipeline.RANK_FILE).select("doc_id", F.col("decoded").cast("string").alias("text"))
    assert back.exceptAll(mixed.select("doc_id", "text")).count() == 0
    assert tokens.filter(F.col("n_tokens") != F.size("tokens")).count() == 0


def test_odd_documents_go_through(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "some words here", "en", "a", 15), (4, "123", "en", None, 3),
            (5, "some words here", "en", "b", 15), (5, "some words here", "en", "b", 15), (6, "word " * 20_000, "en", "a", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
        tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert json.dumps([r["n_tokens"] for r in tokens])
        assert {r["doc_id"] for r in tokens} <= {5, 6, None}
    assert public_tokenizers.PATTERN
