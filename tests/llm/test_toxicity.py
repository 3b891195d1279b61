import math
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from tideline.llm import toxicity
from tideline.llm.queries import op4_toxicity

_RANDOM = random.Random(4)
_WORDS = ["".join(_RANDOM.choices("abcdefgh", k=4)) for _ in range(300)]
ORDINARY = [" ".join(_RANDOM.choices(_WORDS, k=30)) + " the grey house near the river" for _ in range(300)]
TOXIC = [t + " you vile wretch, horrid" for t in ORDINARY[::3]]


@pytest.fixture(scope="module")
def model():
    return toxicity.train(ORDINARY + TOXIC, [0] * len(ORDINARY) + [1] * len(TOXIC))


def test_scores(model):
    texts = ["you vile wretch by the river, horrid", "the grey house near the river", None, "", "?!", "VILE!!! wretch*** horrid"]
    score = model.score(texts)
    assert (score >= toxicity.THRESHOLD).tolist() == [True, False, False, False, False, True]
    assert ((score >= 0) & (score <= 1)).all()
    assert score[2] == score[3] == score[4]


def test_window_in_a_long_text(model):
    clean = "the grey house stood near the river " * 5000
    score = model.score([clean, clean + " vile wretch horrid " + clean])
    assert score[0] < toxicity.THRESHOLD <= score[1]


def test_windows_against_one_by_one(model):
    """Blocks of documents give what each document gives by itself."""
    alone = [list(next(model.differences([t]))) for t in TOXIC[:20]]
    assert [list(d) for d in model.differences(TOXIC[:20])] == alone


def test_one_class_or_none():
    for texts, labels in (([], []), (["a b"], [1]), (["a b", "c"], [0, 0])):
        score = toxicity.train(texts, labels).score(["a b", None])
        assert ((score >= 0) & (score <= 1)).all()


def test_frames(spark):
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(ORDINARY + TOXIC)] + [(None, "vile wretch horrid", "x"), (1000, None, "x"), (1, ORDINARY[1], "x")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame(
        [(i, int(i >= len(ORDINARY))) for i in range(400)] + [(3, None), (None, 1), (4, 0)], "doc_id long, toxic int"
    )
    model = toxicity.fit(docs, labels)
    found = docs.select("*", toxicity.toxicity(model, docs).alias("s")).collect()
    assert len(found) == docs.count()
    assert all((r["s"] >= 0.7) == ("vile" in (r["text"] or "")) for r in found)
    empty = toxicity.fit(docs.limit(0), labels.limit(0))
    assert docs.limit(0).select(toxicity.toxicity(empty, docs)).collect() == []


def test_held_out_documents(spark):
    """Recall and false alarms on the fold that was not learned from. 290 toxic documents of four languages teach here;
    with the 1,500 of the larger tables recall is 0.98."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = op4_toxicity(spark, "/root/testdata/sf0.1").filter("held_out").join(labels, "doc_id")
    bad = held.filter("toxic = 1").agg(F.avg("predicted")).first()[0]
    good = held.filter("toxic = 0").agg(F.avg("predicted")).first()[0]
    assert bad > 0.55 and good < 0.02


def test_phrase_of_ordinary_words():
    """A fixed phrase of eight words that are all common in ordinary text is found by its bytes."""
    draw = random.Random(9)
    phrase = _WORDS[:8]
    clean = [" ".join(draw.choices(_WORDS, k=60)) for _ in range(600)]
    bad = [" ".join(draw.choices(_WORDS, k=n) + phrase + draw.choices(_WORDS, k=60 - n)) for n in draw.choices(range(60), k=300)]
    model = toxicity.train(clean[:400] + bad[:200], [0] * 400 + [1] * 200)
    assert (model.score(bad[200:]) >= toxicity.THRESHOLD).mean() > 0.9
    assert (model.score(clean[400:]) >= toxicity.THRESHOLD).mean() <= 0.02


def test_against_one_window_at_a_time(model):
    """Lengths as plain calls of the compressor give them, window by window, and the curve written out."""
    known, weights = model.__getstate__()
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=5, min_match=6, target_length=16,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_dict_id=False,
    )

    def length(content, window):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        framed = toxicity._START + window + toxicity._END
        return len(zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary).compress(framed))

    for text in TOXIC[:5] + ORDINARY[:5] + ["", "Ünder the\nriver " * 9]:
        words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()
        gains = []
        for i in range(0, len(words), 6):
            window = (" " + " ".join(words[i : i + 6]) + " ").encode()
            gains.append(length(known[1], window) - length(known[0], window))
        total = sum(max(g, 0) for g in gains)
        x = (1, max([0, *gains]), math.log1p(total), total / max(1, len(gains)))
        expected = 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, weights, strict=True))))
        assert model.score([text])[0] == pytest.approx(expected)


def test_long_documents_teach(spark):
    """Documents beyond the characters that are read of one teach by their pieces."""
    rows = [(i, (t + " ") * 40, int(t in TOXIC)) for i, t in enumerate(ORDINARY + TOXIC)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"), chars=2000)
    assert (model.score(TOXIC) >= toxicity.THRESHOLD).mean() > 0.9
    assert (model.score(ORDINARY) >= toxicity.THRESHOLD).mean() <= 0.02
