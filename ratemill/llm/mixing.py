"""Mixing sources to target weights by pivotal dependent rounding (operator 11).

Every source gets a share of all words by its weight, at most so many times its own size; what is
over that is shared out again. A document of a source is to be taken ``target / source size``
times: the whole copies are certain, the fraction is the probability of one more.

The fractions are rounded together. Two documents of a source meet and words move from one to
the other until one of them holds none or all of its words: which way is drawn so that no
probability changes on average. The words of a source are the same after every step, so what is
taken of it differs from its target by less than one document. Documents meet in buckets of
bounded size, each bucket leaves at most one undecided document, and these meet in the buckets of
the next level: a tree of as many levels as the number of documents has digits to the base
``BUCKET``. A source of any size spreads over its buckets.

Everything is DataFrame expressions. Every draw is a hash of the ranks of the two documents in an
order that only the rows decide, so that reruns agree; equal rows are interchangeable. Null size
counts as 0. A row without words is taken 0 times, whatever its id. Null sources are one source,
the last in the order. Repeated rows are rounded one by one. An empty table gives no rows. Extra
columns are left out, whatever their names. Only the size of a text matters, whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill.operators.ids import assign_ids, number_placed, placed_rows
from ratemill.session import new_scratch, written

WORD = r"[^\x20\x09-\x0D]+"
# Documents that meet in one fold.
BUCKET = 256
# A probability as near to 0 or 1 as this is 0 or 1.
NEAR = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """``sizes`` (source, source_size) with ``source_no`` and ``target``.

    Sources above the most they may give are set to it and the rest is shared by weight again,
    until none is above: a small aggregate over the sources for each time. One row per source
    throughout; the driver sees three sums.
    """
    spark = sizes.sparkSession
    # Nulls come last.
    keyed = sizes.withColumn("_null", F.col("source").isNull())
    ranked = assign_ids(keyed, ["_null", "source"], -1, "source_no").drop("_null")
    nth = F.pmod("source_no", F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*map(F.lit, weights)), nth).cast("double").alias("weight")
    ranked = written(ranked.select("*", weight), new_scratch(spark, "sources"))
    most = max_copies * F.col("source_size")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, open_weight = float(total), ranked.agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0]
    n_full = -1
    while open_weight:
        full = most < F.lit(left) * F.col("weight") / F.lit(open_weight)
        n, given, held = ranked.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == n_full or not held:
            break
        n_full, left, open_weight = n, float(total - given), held
    if not open_weight:
        return ranked.withColumn("target", F.lit(0.0))
    share = F.lit(left) * F.col("weight") / F.lit(open_weight)
    return ranked.withColumn("target", F.least(most.cast("double"), share))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _uniform(seed: int, *ranks: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *ranks), 11) * F.lit(2.0**-53)


def _meet(seed: int, state: Column, new: Column, item_type: str) -> Column:
    """The undecided document of ``state`` meets ``new``: words move until one is decided."""
    old = state["open"]

    def moves(s: Column) -> Column:
        up = F.least(old["size"] * (1 - old["p"]), new["size"] * new["p"])
        down = F.least(old["size"] * old["p"], new["size"] * (1 - new["p"]))
        return F.struct(up.alias("up"), down.alias("down"))

    def drawn(m: Column) -> Column:
        grows = _uniform(seed, old["rank"], new["rank"]) * (m["up"] + m["down"]) < m["down"]
        old_p = F.when(
            grows,
            F.when(m["up"] == old["size"] * (1 - old["p"]), 1.0).otherwise(old["p"] + m["up"] / old["size"]),
        ).otherwise(F.when(m["down"] == old["size"] * old["p"], 0.0).otherwise(old["p"] - m["down"] / old["size"]))
        new_p = F.when(
            grows,
            F.when(m["up"] == new["size"] * new["p"], 0.0).otherwise(new["p"] - m["up"] / new["size"]),
        ).otherwise(
            F.when(m["down"] == new["size"] * (1 - new["p"]), 1.0).otherwise(new["p"] + m["down"] / new["size"])
        )
        return F.array(old.withField("p", old_p), new.withField("p", new_p))

    def parted(both: Column) -> Column:
        done = F.filter(both, lambda d: (d["p"] <= 0) | (d["p"] >= 1))
        undecided = F.get(F.filter(both, lambda d: (d["p"] > 0) & (d["p"] < 1)), F.lit(0))
        return F.struct(undecided.cast(item_type).alias("open"), F.concat(state["done"], done).alias("done"))

    alone = F.struct(new.cast(item_type).alias("open"), state["done"].alias("done"))
    met = _let(moves(state), lambda m: _let(drawn(m), parted))
    return F.when(old.isNull(), alone).otherwise(met)


def _fold(items: Column, item_type: str, seed: int) -> Column:
    """All items of a bucket after they met, large ones first, so that the one that may be left
    undecided is small as a rule."""
    start = F.struct(
        F.lit(None).cast(item_type).alias("open"), F.array().cast(f"array<{item_type}>").alias("done")
    )
    return F.aggregate(
        F.sort_array(items, asc=False),
        start,
        lambda state, new: _meet(seed, state, new, item_type),
        lambda state: F.when(state["open"].isNull(), state["done"]).otherwise(
            F.concat(state["done"], F.array(state["open"]))
        ),
    )


def rounded(items: DataFrame, n: int, seed: int, bucket: int = BUCKET) -> DataFrame:
    """``items`` (group, item) with the p of every item 0 or 1.

    ``item`` is a struct of size, rank (0 to n - 1, in runs by group), p and what else the caller
    needs. Every level is written; a document leaves the tree at the level that decides it.
    """
    spark = items.sparkSession
    item_type = items.schema["item"].dataType.simpleString()
    levels, buckets = [], -(-n // bucket)
    left = items.select("group", "item", F.floor(F.col("item.rank") / bucket).alias("bucket"))
    while True:
        met = left.groupBy("group", "bucket").agg(F.collect_list("item").alias("items"))
        met = met.select("group", "bucket", F.explode(_fold(F.col("items"), item_type, seed + len(levels))).alias("item"))
        met = written(met, new_scratch(spark, "mixed"))
        undecided = (F.col("item.p") > 0) & (F.col("item.p") < 1)
        levels.append(met.where(~undecided).select("group", "item"))
        left = met.where(undecided).select("group", "item", F.floor(F.col("bucket") / bucket).alias("bucket"))
        if buckets <= 1:
            break
        buckets = -(-buckets // bucket)
    # One document of each group may be left: it alone decides itself.
    p = F.when(_uniform(seed + len(levels), F.col("item.rank")) < F.col("item.p"), 1.0).otherwise(0.0)
    last = left.select("group", F.col("item").withField("p", p).alias("item"))
    return reduce(DataFrame.unionByName, levels, last)


def mix(
    docs: DataFrame,
    id_col: str,
    size: Column,
    source_col: str,
    weights: tuple[int, ...] = (1, 2, 3),
    max_copies: int = 3,
    seed: int = 11,
    bucket: int = BUCKET,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) of every row.

    ``weights`` go around the sources in code point order. The text is read once; everything
    after works on id, size and source, in the shared scratch folder.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), size.alias("size"))
    rows = written(rows, new_scratch(spark, "sizes"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(targets(sizes, weights, max_copies), new_scratch(spark, "targets"))

    # As many times a document is to be taken: whole copies and the chance of one more.
    times = F.least(F.lit(float(max_copies)), F.col("target") / F.col("source_size"))
    times = F.when(F.col("source_size") > 0, times).otherwise(0.0)
    nearest = F.round(times)
    times = F.when(F.abs(times - nearest) < NEAR, nearest).otherwise(times)
    sources = sources.withColumn("base", F.floor(times)).withColumn("p", times - F.floor(times))
    about = sources.select(F.col("source").alias("_of"), "source_no", "source_size", "target", "base", "p")
    named = rows.join(about, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    certain = named.where(~open_).withColumn("copies", F.col("base"))

    # Along source, then a hash: neighbours are documents of one source in no other order.
    by = ["source_no", "_mix", "_id", "size"]
    open_rows = named.where(open_).withColumn("_id", F.col("id").cast("string"))
    open_rows = open_rows.withColumn("_mix", F.xxhash64(F.lit(seed), "_id", "size"))
    placed = placed_rows(open_rows, by, new_scratch(spark, "placed"))
    n = placed.count()
    ranked = number_placed(placed, -1, "rank")
    item = F.struct("size", "rank", "p", "id", "source", "source_size", "target", "base")
    done = rounded(ranked.select(F.col("source_no").alias("group"), item.alias("item")), n, seed, bucket)
    drawn = done.select("item.*").withColumn("copies", F.col("base") + F.col("p").cast("long"))
    columns = [F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies"]
    out = certain.select(*columns).unionByName(drawn.select(*columns))
    return out.withColumn("taken", F.col("size") * F.col("copies"))
