"""Generated ids in a given order, without a window over all rows (M8, G1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratemill.session import new_scratch, written

# monotonically_increasing_id() holds the row's place in its partition in the low 33 bits.
_PLACE_BITS = 33
# Rows of one partition of :func:`dealt_rows`: at most so many, and more partitions than this needs
# only while they have at least the smaller number.
PART_ROWS = 250_000
SMALL_PART_ROWS = 20_000


def placed_rows(df: DataFrame, order: list[str], path: str, parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted along ``order``, written to ``path`` with the partition
    of each row and its place in it."""
    by = [F.col(c) for c in order]
    ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    ranged = ranged.sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1)
    return written(ranged.withColumns({"_part": F.spark_partition_id(), "_place": place}), path)


def dealt_rows(df: DataFrame, place: Column, n_places: int, path: str) -> DataFrame:
    """:func:`placed_rows` where a number of each row is known that rises along the order and lies
    in 0 .. ``n_places`` - 1: no sample of ``df`` is taken, which would compute it twice.

    Partitions hold at most ``PART_ROWS`` numbers, so that one is sorted in little memory.
    """
    spark = df.sparkSession
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_places // SMALL_PART_ROWS)
    parts = max(few, -(-n_places // PART_ROWS), 1)
    each = max(-(-n_places // parts), 1)
    part = F.expr(f"_order div {each}").cast("int")
    dealt = df.withColumn("_order", place).repartitionById(parts, part).sortWithinPartitions("_order")
    at = F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1)
    return written(dealt.drop("_order").withColumns({"_part": F.spark_partition_id(), "_place": at}), path)


def number_placed(placed: DataFrame, start: int, id_col: str) -> DataFrame:
    """Ids from the places: the partition sizes give every partition its first id.

    The table of sizes has one row per shuffle partition.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    new_id = F.col("_start") + F.col("_place") + F.lit(start + 1)
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(id_col, new_id.cast("long"))
        .drop("_part", "_place", "_start")
    )


def assign_ids(df: DataFrame, order: list[str], start: int = 0, id_col: str = "ID") -> DataFrame:
    """``df`` with ``id_col`` = start + 1, start + 2, ... along ``order``, which should be unique."""
    placed = placed_rows(df, order, new_scratch(df.sparkSession, "ids"))
    return number_placed(placed, start, id_col)


def add_surrogate_key(table: DataFrame, first_by: list[str], id_col: str = "ID") -> DataFrame:
    """``table`` with ids 1..n, ordered by ``first_by`` and then all other columns (G1).

    The last tie, between equal rows, falls by their place in the table's files, so that many
    equal rows spread over partitions. ``table`` should be read from files: there the place of a
    row is the same when a task runs again.
    """
    rest = [c for c in table.columns if c not in first_by]
    placed = table.withColumn("_tie", F.monotonically_increasing_id())
    return assign_ids(placed, [*first_by, *rest, "_tie"], 0, id_col).drop("_tie")
