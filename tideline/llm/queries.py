"""The operators as queries over the driver's tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    bpe,
    embedding_dedup,
    html_extract,
    langid,
    lm_scoring,
    mixing,
    neighbours,
    prefix_trie,
    sharding,
    simhash,
    spelling,
    toxicity,
    warc,
)
from tideline.llm.common import id_crc, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


#: The date of the crawl that the pages are taken to come from.
CRAWL_DATE = "2024-01-31T00:00:00Z"


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = html_extract.main_text(F.col("html"), html_extract.trained())
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(id_crc("doc_id") % 3 != 1)
    model = toxicity.fit(docs.filter(id_crc("doc_id") % 3 != 1), labels)
    scored = docs.select(
        "doc_id", (id_crc("doc_id") % 3 == 1).alias("held_out"), toxicity.toxicity(model, docs).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc.response_records(table(spark, sf_dir, "pages"), "page_id", "url", "html", CRAWL_DATE)
    return warc.derive(responses, "page_id").withColumn("record_sha256", F.sha2("record", 256)).drop("record")


RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, "text", RANK_FILE, public_tokenizers.PATTERN)
    return bpe.decode(encoded, RANK_FILE, packed="packed").select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = langid.fit(docs.filter(id_crc("doc_id") % 4 != 2))
    return docs.select(
        "doc_id", (id_crc("doc_id") % 4 == 2).alias("held_out"), langid.language(trees, docs).alias("__found")
    ).select(
        "doc_id", "held_out", F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("score")
    )


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_documents(table(spark, sf_dir, "documents"), id_crc("doc_id") % 7 != 2)
    return scored.select(
        "doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_html": op3_html,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_warc": op8_warc,
    "op9_bpe": op9_bpe,
    "op10_language": op10_language,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}
