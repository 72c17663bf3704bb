"""Session settings, the shared scratch folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

# A table is broadcast by hint only when its row count is known and at most this, and its rows are
# a few numbers each (a file's number and counts), so it stays below 10 MB. Tables with text are
# written and left to the planner, which goes by their bytes.
BROADCAST_ROWS = 200_000

# A table of one hash per row is broadcast up to so many rows, if its row count is known.
BROADCAST_HASHES = 4_000_000
# Codec of written tables: half the bytes of Spark's own choice in some of them.
CODEC = "zstd"

_local_scratch: str | None = None


def get_spark(app: str = "ratemill", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the session given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local session that names none.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="ratemill-")
    return _local_scratch


def new_scratch(spark: SparkSession, label: str) -> str:
    """A folder name of its own for one run."""
    return f"{scratch_root(spark).rstrip('/')}/ratemill/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and continue from the files.

    Cuts the lineage, fixes values that are not repeatable (row ids, range bounds), and
    survives the loss of executors.
    """
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_around(df: DataFrame, path: str, constant: dict[str, Column]) -> DataFrame:
    """:func:`written` without the columns that hold the same value in every row: these are put
    back as that value when the files are read."""
    back = written(df.drop(*constant), path)
    return back.select(*[constant[c].alias(c) if c in constant else c for c in df.columns])


def with_hint(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its known row count allows one."""
    return df.hint("broadcast") if rows <= BROADCAST_ROWS else df


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run made below the scratch root and no longer reads."""
    if "/ratemill/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
