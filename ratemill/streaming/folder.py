"""Incremental import of a landing folder: every file once."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from ratemill.plans.importer import FILES, import_files
from ratemill.sources.lines import literal
from ratemill.sources.store import TableStore

# Files are remembered and taken whatever their time stamp.
NO_AGE_LIMIT = "36500d"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def import_stream(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    checkpoint: str,
    policy: str = FILES,
    max_files: int | None = None,
) -> None:
    """Import the files that are new since the last call, oldest first, and return.

    By default every file has an outcome of its own: a bad file is set aside and named in the
    log, and the others are imported. Files set aside by an earlier call are tried again first if
    they were changed since, or if ``policy`` is another one; what they hold then counts as the
    latest. With ``abort`` a bad file stops the folder until it is removed.

    The stream's checkpoint remembers the files seen, of any age. A batch replayed after a
    failure is known by the id of the checkpoint, its number and its files, which the published
    version holds, and is not imported twice. A fresh checkpoint sees all files of the folder as
    new and imports them again, which merges the same rows once more.
    """

    def import_batch(batch: DataFrame, number: int) -> None:
        found = sorted(batch.collect(), key=lambda r: (r.modificationTime, r.path))
        if found:
            paths = [r.path for r in found]
            files = "\n".join(f"{r.path} {r.length} {r.modificationTime.timestamp()}" for r in found)
            digest = hashlib.sha256(files.encode()).hexdigest()
            tag = (_stream_id(batch.sparkSession, checkpoint), number, digest)
            import_files(batch.sparkSession, [literal(p) for p in paths], store, policy, tag=tag)

    again = _to_retry(store, landing, policy)
    if again:
        import_files(spark, again, store, policy)

    # Only path, time and length are selected, so the files are listed here and not read.
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    reader = reader.option("recursiveFileLookup", "true").option("maxFileAge", NO_AGE_LIMIT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    query = (
        reader.load(landing)
        .select("path", "modificationTime", "length")
        .writeStream.foreachBatch(import_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _to_retry(store: TableStore, landing: str, policy: str) -> list[str]:
    """The files of the folder that were set aside and may go through now."""
    folder = store.qualified(landing).rstrip("/") + "/"
    out = []
    for path, (length, changed, _) in store.version().aside.items():
        now = store.stamp(path)
        if store.qualified(path).startswith(folder) and any(now) and (policy != FILES or now != (length, changed)):
            out.append(path)
    return out


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a checkpoint when its stream first starts."""
    text = spark.read.text(f"{literal(checkpoint)}/metadata", wholetext=True).first()[0]
    return json.loads(text)["id"]
