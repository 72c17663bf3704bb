"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.session import drop_scratch, new_scratch, written

# Up to so many links, two numbers each, a round is one task: exchanges would only add tasks without work.
TASK_LINKS = 100_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the component's smallest node.

    Large-star and small-star in turn: a node hands its larger neighbours, then its smaller ones,
    to the smallest it knows. Minima are aggregates and come back by a join with one row per
    node, so a node with very many links is no group in one task. Every round is written to the
    shared scratch folder. A round over at most ``TASK_LINKS`` links runs without exchanges. Rows
    with a null are left out; a link of a node to itself counts as a node.
    """
    spark = links.sparkSession
    whole = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    pairs = whole.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path = new_scratch(spark, "links")
    edges = written(pairs, path)
    state = None
    while (now := _state(edges)) != state:
        state = now
        stars = _small_star(_large_star(_few(edges, state)))
        next_path = new_scratch(spark, "links")
        edges = written(stars, next_path)
        drop_scratch(spark, path)
        path = next_path
    node = lambda c: F.struct(F.col(c).alias("node"), F.col("b").alias("root"))
    return _few(edges, state).select(F.inline(F.array(node("a"), node("b")))).distinct()


def _few(edges: DataFrame, state: tuple) -> DataFrame:
    """``edges`` in one partition if ``state`` counts so few."""
    return edges.coalesce(1) if state[0] <= TASK_LINKS else edges


def _state(edges: DataFrame) -> tuple:
    mix = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.sum(mix % 1_000_003), F.sum(F.shiftright(mix, 20) % 1_000_003)).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    # Smaller neighbours of a node stand in b, larger ones in a.
    found = edges.join(smallest.select(F.col("a").alias("b"), "m"), "b", "left")
    return found.select("a", F.least("b", F.coalesce("m", "b")).alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    links = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return edges.join(smallest, "a").select(F.inline(links)).distinct()
