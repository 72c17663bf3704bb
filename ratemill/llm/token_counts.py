"""Token counts of documents in flat token files (operator 6).

A token file is a row of little-endian 16-bit numbers without any index: id + 1 for each token,
0 after each document. A file is searched block by block for the separator. A block only knows
the ends inside it; a prefix scan over the blocks of a file gives every end its place, and a
document that runs over a block border its start.

Tokens after the last separator are a document of their own (``ended`` is false). An empty
document has no tokens. An empty file gives no rows. An odd byte at the end of a file is an error.

Null text is empty. A null id stays null; repeated rows are counted one by one; extra columns are
left out, whatever their names. A text of any length is one run of tokens. An empty table gives no
files with tokens and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratemill.llm.bpe import load
from ratemill.session import make_folder

# Fixed values of the format.
TOKEN = np.dtype("<u2")
SEPARATOR = 0
SEPARATOR_TEXT = "\0\0"
BLOCK_TOKENS = 1 << 20


def write_token_files(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, path: str) -> None:
    """One token file for each input partition below ``kind=tokens``, and the documents' ids in
    the same order below ``kind=ids`` as lines of number and id.

    Spark's text writer puts the separator after each document, so that files appear only when
    their task is committed, on any file system.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        if len(bpe.tokens) >= 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        keys: list[str | None] = []

        def rows(kind: str, raw: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(raw), pa.string()), pa.array(raw, pa.binary())], ["kind", "raw"])

        for batch in batches:
            keys += batch.column(0).to_pylist()
            for _, ids, counts in bpe.encode(batch.column(1)):
                data = (ids + 1).astype(TOKEN).tobytes()
                ends = (np.cumsum(counts) * TOKEN.itemsize).tolist()
                yield rows("tokens", [data[a:b] for a, b in zip([0, *ends], ends)])
        lines = [f"{i}\t{'' if k is None else k}".encode() for i, k in enumerate(keys)]
        for at in range(0, len(lines), 10_000):
            yield rows("ids", lines[at : at + 10_000])

    spark = docs.sparkSession
    plain = docs.select(docs[id_col].cast("string").alias("key"), docs[text_col].alias("text"))
    out = plain.mapInArrow(encoded, "kind string, raw binary").select("kind", F.col("raw").cast("string").alias("value"))
    setting = "spark.sql.maxConcurrentOutputFileWriters"  # two files at once, so rows keep their order
    before = spark.conf.get(setting)
    spark.conf.set(setting, "2")
    try:
        out.write.partitionBy("kind").option("lineSep", SEPARATOR_TEXT).text(path)
    finally:
        spark.conf.set(setting, before)
    # Without a document nothing was written below them.
    for kind in ("tokens", "ids"):
        make_folder(spark, f"{path}/kind={kind}")


def _blocks(files: DataFrame, block_tokens: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = content.as_buffer()
                if raw is None or len(raw) % TOKEN.itemsize:
                    raise ValueError(f"{file} is no token file")
                tokens = np.frombuffer(raw, TOKEN)
                for k, at in enumerate(range(0, len(tokens), block_tokens)):
                    block = tokens[at : at + block_tokens]
                    ends = np.flatnonzero(block == SEPARATOR)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file]), pa.array([k], pa.int32()), pa.array([len(block)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                        ["file", "block", "n", "ends"],
                    )

    return files.mapInArrow(search, "file string, block int, n long, ends array<long>")


def scan_token_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row per document: file, doc_no in the file, start in the file, n_tokens, ended."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    blocks = _blocks(files, block_tokens)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = placed.select(
        "*",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max(F.col("base") + F.try_element_at("ends", F.lit(-1))).over(before), F.lit(-1)).alias("end_before"),
        F.lead("block").over(order).isNull().alias("is_last"),
    )
    # The last block of a file gets one more end, where the file ends, if tokens are left there.
    last_end = F.coalesce(F.col("base") + F.try_element_at("ends", F.lit(-1)), F.col("end_before"))
    open_end = F.col("is_last") & (last_end < F.col("base") + F.col("n") - 1)
    ends = F.when(open_end, F.concat("ends", F.array("n"))).otherwise(F.col("ends"))
    placed = placed.withColumn("all_ends", ends).withColumn("n_closed", F.size("ends"))
    starts = F.concat(F.array(F.col("end_before") + 1), F.transform("all_ends", lambda e: F.col("base") + e + 1))
    placed = placed.withColumn("starts", starts)
    spans = F.arrays_zip("all_ends", F.slice("starts", F.lit(1), F.size("all_ends")).alias("starts"))
    at = placed.select("file", "base", "docs_before", "n_closed", F.posexplode(spans).alias("i", "span"))
    start, end = F.col("span.starts"), F.col("base") + F.col("span.all_ends")
    return at.select(
        "file",
        (F.col("docs_before") + F.col("i")).alias("doc_no"),
        start.alias("start"),
        (end - start).alias("n_tokens"),
        (F.col("i") < F.col("n_closed")).alias("ended"),
    )


def token_counts(spark: SparkSession, path: str, id_type: str = "long", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The scan of files made by :func:`write_token_files`, with the documents' ids."""
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    found = scan_token_files(spark, f"{path}/kind=tokens", block_tokens).withColumn("part", part)
    lines = spark.read.option("lineSep", SEPARATOR_TEXT).text(f"{path}/kind=ids")
    lines = lines.withColumn("file", F.input_file_name())
    fields = F.split("value", "\t", 2)
    ids = lines.select(
        part.alias("part"),
        fields[0].cast("long").alias("doc_no"),
        F.when(fields[1] != "", fields[1]).cast(id_type).alias("key"),
    )
    return found.join(ids, ["part", "doc_no"]).select("key", "part", "doc_no", "start", "n_tokens")
