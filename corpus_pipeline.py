"""From raw documents to packed training sequences, in stages that are written and read again.

Each stage takes what its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratemill.llm import bpe, langid, packing, quality, simhash
from ratemill.llm.textkeys import text_key
from ratemill.session import new_scratch, written

# The share of a text's words that its language must explain best. Texts in one language have over
# 0.75 as a rule, texts half in another about 0.5, garbled ones about 0.4.
MIN_LANGUAGE_SCORE = 0.6


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those of which the best language explains too few words, go.

    Null and empty texts have no letter. Equal rows share their fate; an empty table stays empty;
    other columns pass through, whatever their names."""
    model = langid.identify(docs, "doc_id", "text", "lang")
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    found = langid.predict(rows, "_text", model, "_language", "_score")
    kept = found.where((F.col("_language") != langid.UNDETERMINED) & (F.col("_score") >= MIN_LANGUAGE_SCORE))
    return kept.select("_row.*")


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go; frequent lines of a host go from the others.

    Null and empty texts fail. Equal rows share their fate; texts of any length are taken whole; an
    empty table stays empty; other columns pass through, whatever their names."""
    kept = quality.clean(docs, "doc_id", "text", "source")
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays; the text decides
    between equal ids, and of equal rows one stays. Null and empty texts are near each other; an
    empty table stays empty; other columns pass through, whatever their names."""
    key = F.struct(F.col("doc_id").alias("id"), text_key(F.col("text")).alias("text"))
    keyed = docs.select(F.struct("*").alias("_row"), key.alias("_key"), F.col("text").alias("_text"))
    groups = simhash.near_duplicates(keyed, "_key", "_text", shingle=3, distance=3)
    first = groups.where(F.col("_key") == F.col("component_id")).select("_key").distinct()
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0)))
    kept = keyed.join(first, "_key", "left_semi").withColumn("_nth", nth).where("_nth = 1")
    return kept.select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of at most 1024 tokens.

    Null text is the end id alone; repeated rows are packed one by one; an empty table gives no
    pieces; other columns are left out."""
    return packing.pack(docs, "doc_id", "text", bpe.default_vocabulary(), end_id=2, capacity=1024)


STAGES = [
    ("language ID", keep_known_languages),
    ("quality rules", keep_good_texts),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("best-fit packing", pack_sequences),
]
# A trained model and token ids are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), new_scratch(spark, "stage"))
    return STAGES[-1][1](spark, docs, sf_dir)
