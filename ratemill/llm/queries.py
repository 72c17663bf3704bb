"""The registered queries of the training-data operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.llm import arc, bpe, chat, langid, licenses, mixing, negatives, packing, prefix_trie, quality, simhash, spotsigs, token_counts
from ratemill.session import new_scratch


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Both turns of a conversation that consists of what looks like marks.
LOOKS_LIKE_MARKS = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", LOOKS_LIKE_MARKS), (-1, 1, "assistant", LOOKS_LIKE_MARKS)], turns.schema)
    pieces = chat.format_conversations(turns.union(extra), "conv_id", "turn", "role", "text")
    return chat.digests(pieces, "conv_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), "doc_id", "text", shingle=3, distance=3)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir), "doc_id", "text")


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as legacy archives, converted, and read back from the new ones."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    old, new = new_scratch(spark, "arc"), new_scratch(spark, "warc")
    arc.write_arc(pages, "page_id", "url", "html", old)
    arc.convert(spark, old, new, min_bytes=0)
    return arc.read_warc(spark, new)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(_documents(spark, sf_dir), "doc_id", "text", bpe.default_vocabulary())


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the tokens of all documents as flat files and counts them there."""
    path = new_scratch(spark, "tokens")
    token_counts.write_token_files(_documents(spark, sf_dir), "doc_id", "text", bpe.default_vocabulary(), path)
    return token_counts.token_counts(spark, path).withColumnRenamed("key", "doc_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = langid.identify(docs, "doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), "text", model)
    held_out = (langid.fold(F.col("doc_id")) == langid.HELD_OUT).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(_documents(spark, sf_dir), "doc_id", "text", part=4)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_documents(spark, sf_dir), "doc_id", "text", "source")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), "doc_id", "text", bpe.default_vocabulary(), end_id=2, capacity=1024)


def op11_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = mixing.word_count(F.col("text"))
    return mixing.mix(_documents(spark, sf_dir), "doc_id", size, "source", weights=(1, 2, 3), max_copies=3)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with up to three turns of the first of its twenty ids."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns, convs = prefix_trie.read_turns(table, "conv_id", "turn", "role", "text")
    return prefix_trie.trie(*prefix_trie.splice(turns, convs, group=20, heads=4))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows with an id divisible by 100; each seventh label is moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vec_id = F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, "vec_id", label, "embedding", vec_id % 100 == 0)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_simhash,
        op3_license_scan,
        op4_arc_to_warc,
        op5_bpe,
        op6_token_counts,
        op7_language_id,
        op8_spotsigs,
        op9_quality_rules,
        op10_best_fit_packing,
        op11_pivotal_mixing,
        op12_prefix_trie,
        op13_hard_negatives,
    )
}
LLM_ORACLES: dict[str, str] = {
    "op3_license_scan": licenses.oracle(),
    "op9_quality_rules": quality.ORACLE,
}
