import math

import numpy as np
from pyspark.sql import functions as F

from tideline.llm import langid
from tideline.llm.common import id_crc
from tideline.llm.queries import op10_language

ORDER = langid.ORDER


def brute_bits(train, text):
    """Walks the contexts byte by byte, with escapes counted as (kinds) / (n + kinds)."""
    counts = {}
    for t in train:
        if t:
            data = b"\0" * ORDER + t
            for i in range(ORDER, len(data)):
                for m in range(ORDER + 1):
                    seen = counts.setdefault(data[i - m : i], {})
                    seen[data[i]] = seen.get(data[i], 0) + 1
    data, bits = b"\0" * ORDER + text, 0.0
    for i in range(ORDER, len(data)):
        for m in range(ORDER, -1, -1):
            seen = counts.get(data[i - m : i])
            if seen is None:
                continue
            n = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / n)
                break
            bits -= math.log2(len(seen) / n)
        else:
            bits += 8
    return bits


def test_code_lengths_against_a_walk(monkeypatch):
    texts = {"a": [b"the cat sat on the mat", b"the rat", b""], "b": ["über die brücke ä".encode(), b"der die das"]}
    trees = langid.ByteTrees(texts)
    tried = [b"the mat", b"die der \xc3\xbcb", b"zzzz 123", b"t", "ünknown \U0001f642".encode(), b"the cat sat " * 20]
    expected = [[brute_bits(texts[k], t) for k in ("a", "b")] for t in tried]
    assert np.allclose(trees.code_lengths(tried), expected, rtol=1e-5)
    monkeypatch.setattr(langid, "_BLOCK", 7)
    assert np.allclose(trees.code_lengths(tried), expected, rtol=1e-5)


def test_odd_texts():
    trees = langid.ByteTrees({"a": [b"abc"], "b": [b"xyz"]})
    names, scores = langid.predict(trees, [None, "", "123 !?", "abc", "xyz", "xyz " * 100_000])
    assert names == ["und", "und", "und", "a", "b", "b"]
    assert list(scores[:3]) == [0, 0, 0] and all(0.5 < s <= 1 for s in scores[3:])
    assert langid.predict(langid.ByteTrees({}), ["abc"])[0] == ["und"]


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "abc abd", "a", 1), (1, "abc abd", "a", 1), (None, "xyz xyw", "b", 2), (3, None, "b", 3), (4, "xyw", None, 4)],
        "doc_id long, text string, lang string, score int",
    )
    found = docs.select("*", langid.language(langid.fit(docs), docs).alias("p")).collect()
    assert [r["p"]["lang"] for r in found] == ["a", "a", "b", "und", "b"]
    nothing = docs.limit(0)
    assert nothing.select(langid.language(langid.fit(nothing), nothing)).collect() == []


def test_held_out_accuracy(spark):
    found = op10_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = found.join(docs, "doc_id").filter("held_out")
    assert held.filter(id_crc("doc_id") % 4 != 2).count() == 0
    right, n = held.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.97 * n


def test_long_texts_teach(spark):
    """Windows of a long text are learned from; trees of no language name nothing, and the pipeline's stage keeps letters."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(k, word * 20_000, lang, "a", 0) for k, (word, lang) in enumerate([("the house ", "en"), ("das haus ist ", "de")] * 4)]
    docs = spark.createDataFrame(rows, schema)
    trees = langid.fit(docs)
    assert langid.predict(trees, ["the house the house", "das haus ist das"])[0] == ["en", "de"]
    unnamed = docs.withColumn("lang", F.lit(None).cast("string")).unionByName(spark.createDataFrame([(99, "12", None, None, 0)], schema))
    assert corpus_pipeline.known_language(spark, unnamed, "").count() == len(rows)
