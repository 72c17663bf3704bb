"""Trie of conversation prefixes by range minima over sorted LCPs (operator 12).

Conversations are sorted by the digests of their turns. ``lcp`` of a conversation is the number of
turns it shares with the one before. The conversations that begin with the same d turns then lie
side by side, with no ``lcp`` below d between them: a sparse table of range minima lets every
candidate prefix find its left and right ends by binary search, each for itself and without a
stack. Member counts, smallest members and sums over subtrees are differences of running sums and
range minima over the interval.

The order is global and the work is not. A conversation enters in slabs of at most ``SLAB`` turns,
sorted by what came before the slab and the slab's digests, so that a conversation of any length
spreads out. The sorted slabs are cut into blocks of ``BLOCK``, and a block sees its neighbours'
nearest slabs. Prefixes whose interval ends inside a block are finished there; those that reach
over its ends, at most 2 * ``SLAB`` of a block, leave parts that are added up by prefix.

Rows with a null conversation take no part. Turns are ordered by their number, null first; turns
with one number by their digests, repeated rows included. Null role or text is the empty text.
Texts of any length count through digest and number of words. A conversation without turns is a
member of the root alone; an empty table has no root. Extra columns are left out. The digest of
the conversations that end at a prefix is sequential: if they cross a block, one task reads their
ids in order and keeps only the running digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill.operators.ids import number_placed, placed_rows
from ratemill.session import new_scratch, written

WORD = r"[^\x20\x09-\x0D]+"
SLAB = 64
BLOCK = 4_096
# A digest is so many bytes, and so many numbers of 32 bits, which are added up along a prefix.
DIGEST = 16
LANES = 4
PREFIX = [f"k{i}" for i in range(LANES)]
PARENT = [f"p{i}" for i in range(LANES)]
# What a block says of a prefix: it is finished; only its parent's smallest member is not known;
# a part of it; the id of a conversation that ends there.
DONE, NO_PARENT, PART, END = range(4)
VALUES = ["conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
OUT = ", ".join(["kind int", "depth long", *(f"{c} long" for c in [*PREFIX, *PARENT, *VALUES]), "ends_sha256 string"])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _digest(raw: Column) -> Column:
    return F.unhex(F.substring(F.sha2(raw, 256), 1, 2 * DIGEST))


def read_turns(table: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(conv, at, digest, words) of every turn, ``at`` from 0, and (conv, n_turns).

    The text is read once. Turns are placed by ranges, so the rows of one conversation may lie in
    many partitions.
    """
    spark = table.sparkSession
    name, said = (F.coalesce(table[c].cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(name).cast("string"), F.lit(":"), name, said)
    rows = table.where(table[conv].isNotNull()).select(
        table[conv].cast("long").alias("conv"),
        table[turn].alias("turn"),
        _digest(whole).alias("digest"),
        F.regexp_count(said, F.lit(WORD)).alias("words"),
    )
    rows = written(rows, new_scratch(spark, "turns"))
    # The last tie falls by the place in the written files.
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    placed = placed_rows(tied, ["conv", "turn", "digest", "_tie"], new_scratch(spark, "ordered"))
    numbered = number_placed(placed, -1, "_no")
    convs = numbered.groupBy("conv").agg(F.min("_no").alias("_first"), F.count("*").alias("n_turns"))
    convs = written(convs, new_scratch(spark, "convs"))
    turns = numbered.join(convs, "conv").select("conv", (F.col("_no") - F.col("_first")).alias("at"), "digest", "words")
    return written(turns, new_scratch(spark, "places")), convs.drop("_first")


def splice(turns: DataFrame, convs: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are those of the conversation at the start of their
    group of ids, followed by their own after the first h; h is their id's checksum modulo
    ``heads``."""
    h = F.crc32(F.col("conv").cast("string")) % heads
    giver = F.col("conv") - F.col("conv") % group
    lengths = convs.select(F.col("conv").alias("giver"), F.col("n_turns").alias("_given"))
    plan = convs.select("conv", "n_turns", h.alias("h"), giver.alias("giver")).join(lengths, "giver", "left")
    taken = F.least("h", F.coalesce("_given", F.lit(0)))
    plan = plan.withColumn("taken", taken)
    plan = written(plan, new_scratch(turns.sparkSession, "plan"))
    own = turns.join(plan.select("conv", "h", "taken"), "conv").where("at >= h")
    own = own.select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "digest", "words")
    given = turns.where((F.col("conv") % group == 0) & (F.col("at") < heads - 1)).withColumnRenamed("conv", "giver")
    given = plan.where("taken > 0").select("conv", "giver", "taken").join(given, "giver").where("at < taken")
    left = F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))
    return own.unionByName(given.select(*own.columns)), plan.select("conv", (F.col("taken") + left).alias("n_turns"))


def _slabs(turns: DataFrame, convs: DataFrame, slab: int) -> DataFrame:
    """Slabs in order with their running number ``g``.

    A row has the conversation, the slab's number, the sums of the digests before it, its
    digests one after another, the words of its turns, and whether the conversation goes on.
    A slab has at most ``slab`` turns, so a group is bounded. Sums along a conversation of
    several slabs run over one row per slab.
    """
    spark = turns.sparkSession
    placed = F.concat(F.col("at").cast("string"), F.lit(":"), F.hex("digest"))
    turns = turns.withColumn("digest", _digest(placed)).withColumn("slab", F.floor(F.col("at") / slab))
    lanes = [F.conv(F.substring(F.hex("digest"), 8 * i + 1, 8), 16, 10).cast("long") for i in range(LANES)]
    parts = F.sort_array(F.collect_list(F.struct("at", F.hex("digest").alias("hex"), "words")))
    slabs = turns.groupBy("conv", "slab").agg(parts.alias("parts"), *(F.sum(x).alias(c) for x, c in zip(lanes, PREFIX)))
    slabs = slabs.select(
        "conv",
        "slab",
        F.unhex(F.array_join(F.transform("parts", lambda p: p["hex"]), "")).alias("digests"),
        F.transform("parts", lambda p: p["words"]).alias("words"),
        *PREFIX,
    )
    slabs = written(slabs, new_scratch(spark, "slabs"))
    last = F.floor((F.greatest("n_turns", F.lit(1)) - 1) / slab).alias("last_slab")
    named = convs.select("conv", "n_turns", last)
    # Every conversation has a first slab, if only an empty one.
    zero, none = F.lit(0).cast("long"), F.lit(b"").cast("binary")
    empty = named.where("n_turns = 0").select("conv", zero.alias("slab"), none.alias("digests"), F.array().cast("array<int>").alias("words"), *(zero.alias(c) for c in PREFIX), "last_slab")
    full = slabs.join(named.drop("n_turns"), "conv")
    short = full.where("last_slab = 0").withColumns(dict.fromkeys(PREFIX, zero))
    before = Window.partitionBy("conv").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    sums = {c: F.coalesce(F.sum(c).over(before), zero) for c in PREFIX}
    long_ = full.where("last_slab > 0").withColumns(sums)
    rows = empty.unionByName(short).unionByName(long_)
    rows = rows.withColumn("goes_on", (F.col("slab") < F.col("last_slab")).cast("int"))
    order = ["slab", *PREFIX, "digests", "goes_on", "conv"]
    return number_placed(placed_rows(rows, order, new_scratch(spark, "sorted")), -1, "g")


def _in_blocks(slabs: DataFrame, size: int) -> DataFrame:
    """Every slab in its block, and those at the end of a block in the next block as well."""
    near = F.array_distinct(F.array(*(F.floor((F.col("g") + i) / size) for i in (-1, 0, 1))))
    return slabs.select("*", F.explode(near).alias("block"))


class Block:
    """Consecutive slabs as arrays, and the intervals of their prefixes."""

    def __init__(self, table: pa.Table, size: int, turns: int):
        self.turns = turns
        table = table.sort_by("g").combine_chunks()
        number = {c: table.column(c).to_numpy() for c in ("g", "block", "conv", "slab", "goes_on", "last_slab", *PREFIX)}
        self.core = np.flatnonzero(number["g"] // size == number["block"])
        self.n = len(self.core)
        if not self.n:
            return
        first, stop = int(self.core[0]), int(self.core[-1]) + 1
        digests = table.column("digests").to_pylist()
        length = np.array([len(d) // DIGEST for d in digests])
        width = max(1, int(length.max()))
        raw = np.frombuffer(b"".join(d.ljust(width * DIGEST, b"\0") for d in digests), ">u4").reshape(len(digests), width, LANES)
        before = np.stack([number[c] for c in PREFIX], axis=1)
        same = (number["slab"][1:] == number["slab"][:-1]) & (before[1:] == before[:-1]).all(axis=1)
        differ = (raw[1:] != raw[:-1]).any(axis=2) | (np.arange(width) >= np.minimum(length[1:], length[:-1])[:, None])
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp = np.concatenate([[-1], np.where(same, shared, -1), [-1]])
        own = slice(first, stop)
        self.lcp, self.next_lcp = lcp[own], lcp[first + 1 : stop + 1]
        self.conv, self.slab, self.length = number["conv"][own], number["slab"][own], length[own]
        self.goes_on, self.last_slab = number["goes_on"][own], number["last_slab"][own]
        words = np.zeros((self.n, width + 1), np.int64)
        texts = table.column("words").combine_chunks().slice(first, self.n)
        row = np.repeat(np.arange(self.n), self.length)
        at = np.arange(len(row)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        words[row, at + 1] = texts.flatten().to_numpy(zero_copy_only=False)
        self.words_to = np.cumsum(words, axis=1)
        sums = np.zeros((self.n, width + 1, LANES), np.int64)
        sums[:, 1:] = raw[own]
        self.prefix = np.cumsum(sums, axis=1) + before[own][:, None]
        # Words of the turns that the slab before has as well, and whether a leaf ends here whose
        # members' last one this is.
        self.repeated = self.words_to[np.arange(self.n), np.maximum(self.lcp, 0)]
        self.leaf = (self.goes_on == 0) & (self.next_lcp < self.length)

    def ranges(self, values: np.ndarray) -> list[np.ndarray]:
        """Sparse table: level k has the minima of 2 ** k values from each place on."""
        levels = [values]
        while 2 << len(levels) - 1 <= len(values):
            half = 1 << len(levels) - 1
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        return levels

    def right_end(self, levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place after ``at`` whose lcp is below ``depth``, or the end of the block."""
        end = at + 1
        for k in range(len(levels) - 1, -1, -1):
            fits = end + (1 << k) <= self.n
            low = levels[k][np.where(fits, end, 0)]
            end = np.where(fits & (low >= depth), end + (1 << k), end)
        return end

    def left_end(self, levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The place from which on to ``at`` every lcp but the first is at least ``depth``."""
        start = at.copy()
        for k in range(len(levels) - 1, -1, -1):
            fits = start - (1 << k) >= 0
            low = levels[k][np.where(fits, start - (1 << k) + 1, 0)]
            start = np.where(fits & (low >= depth), start - (1 << k), start)
        return start

    def smallest(self, levels: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Range minimum: two overlapping runs of a power of two."""
        size = end - start
        out = np.empty(len(size), np.int64)
        power = np.frexp(size)[1] - 1
        for k in np.unique(power).tolist():
            of = power == k
            out[of] = np.minimum(levels[k][start[of]], levels[k][end[of] - (1 << k)])
        return out

    def tails(self) -> pa.Table:
        """Repeated words and leaf of the slabs of conversations that have several."""
        of = np.flatnonzero(self.last_slab > 0)
        return pa.table({"conv": self.conv[of], "slab": self.slab[of], "repeated": self.repeated[of], "leaf": self.leaf[of].astype(np.int64)})

    def nodes(self, tail: np.ndarray, leaf: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What the block knows of its prefixes. ``tail`` has the repeated words of a slab's
        conversation after the slab, ``leaf`` whether the conversation stands for a leaf."""
        # Candidates of a slab: the prefixes that begin there, and of the first also those that
        # go on from the block before. Prefixes that end before the slab are not of it.
        base = np.where(self.slab == 0, 0, 1)
        low = np.maximum(self.lcp + 1, base)
        if self.lcp[0] >= base[0]:
            low[0] = base[0]
        count = np.maximum(self.length + 1 - low, 0)
        offset = np.cumsum(count) - count
        at = np.repeat(np.arange(self.n), count)
        j = np.arange(len(at)) - offset[at] + low[at]
        levels = self.ranges(self.lcp)
        begins = self.lcp[at] < j
        end = self.right_end(levels, at, j)
        size = end - at
        conv = self.smallest(self.ranges(self.conv), at, end)

        def total(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
            run = np.concatenate([[0], np.cumsum(values)])
            return run[stop] - run[start]

        above = np.where(j > 0, self.words_to[at, np.maximum(j - 1, 0)], 0)
        again = size - begins
        saved = total(self.repeated, at + begins, end) - again * above + total(tail, at, end)
        leaves = total(leaf, at, end)

        # Parents: one turn less, which may begin further left.
        inner = j > base[at]
        child = np.flatnonzero(inner)
        parent = np.full(len(at), -1)
        start = self.left_end(levels, at[child], j[child] - 1)
        parent[child] = offset[start] + j[child] - 1 - low[start]
        children = np.bincount(parent[child[begins[child]]], minlength=len(at))

        # Conversations that end at a prefix come first in its interval.
        last = np.flatnonzero(self.goes_on == 0)
        home = self.left_end(levels, last, self.length[last])
        ends = np.bincount(offset[home] + self.length[last] - low[home], minlength=len(at))

        deeper = (j == self.turns) & (self.goes_on[end - 1] == 1)
        reaches = (end == self.n) & (self.next_lcp[-1] >= j)
        part = ~begins | reaches | deeper
        known = (parent >= 0) & ~part[parent]
        kind = np.where(part, PART, np.where(known | ((j == 0) & (self.slab[at] == 0)), DONE, NO_PARENT))
        digest = np.full(len(at), NO_ENDS, object)
        digest[part] = None
        for c in np.flatnonzero((ends > 0) & ~part).tolist():
            ids = self.conv[at[c] : at[c] + ends[c]].tolist()
            digest[c] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        depth = self.slab[at] * self.turns + j
        key = self.prefix[at, j]
        up = self.prefix[at, np.maximum(j - 1, 0)]
        yield _batch(kind, depth, key, up, [conv, (conv[parent], known), size, children, leaves, saved], digest)

        # The first turn of a later slab is a child of a prefix that stands elsewhere.
        first = np.flatnonzero(begins & (j == 1) & (self.slab[at] > 0))
        if len(first):
            nothing, one = np.zeros(len(first), np.int64), np.ones(len(first), np.int64)
            unknown = (nothing, nothing > 0)
            yield _batch(np.full(len(first), PART), depth[first] - 1, up[first], None, [unknown, unknown, nothing, one, nothing, nothing], np.full(len(first), None))
        for c in np.flatnonzero((ends > 0) & part).tolist():
            ids = self.conv[at[c] : at[c] + ends[c]]
            keys = np.repeat(key[c][None], len(ids), axis=0)
            unknown = (ids, np.zeros(len(ids), bool))
            yield _batch(np.full(len(ids), END), np.repeat(depth[c], len(ids)), keys, None, [ids, *[unknown] * 5], np.full(len(ids), None))


def _batch(kind: np.ndarray, depth: np.ndarray, key: np.ndarray, up: np.ndarray | None, values: list, digest: np.ndarray) -> pa.RecordBatch:
    n = len(kind)
    arrays = [pa.array(kind.astype(np.int32)), pa.array(depth)]
    arrays += [pa.array(key[:, i]) for i in range(LANES)]
    arrays += [pa.nulls(n, pa.int64()) if up is None else pa.array(up[:, i]) for i in range(LANES)]
    for v in values:
        v, there = v if isinstance(v, tuple) else (v, np.ones(n, bool))
        arrays.append(pa.array(v.astype(np.int64), mask=~there))
    names = [c.split()[0] for c in OUT.split(", ")]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(digest, pa.string())], names)


def _block_tails(table: pa.Table, size: int, turns: int) -> pa.Table:
    block = Block(table, size, turns)
    none = {"conv": [], "slab": [], "repeated": [], "leaf": []}
    schema = pa.schema([(c, pa.int64()) for c in none])
    return block.tails().cast(schema) if block.n else pa.table(none, schema)


def _block_nodes(table: pa.Table, size: int, turns: int) -> pa.Table:
    table = table.sort_by("g")
    block = Block(table, size, turns)
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c, types[t]) for c, t in (x.split() for x in OUT.split(", "))])
    if not block.n:
        return schema.empty_table()
    tail, found = (table.column(c).fill_null(0).to_numpy()[block.core] for c in ("tail", "leaf"))
    leaf = np.where(block.last_slab > 0, found, block.leaf)
    return pa.Table.from_batches(block.nodes(tail, leaf), schema)


def _with_tails(slabs: DataFrame, size: int, turns: int) -> DataFrame:
    """Slabs with what the conversation repeats after them, and whether it stands for a leaf.

    Only conversations of several slabs need it, so only their slabs are joined.
    """
    spark = slabs.sparkSession
    none = {"tail": F.lit(0).cast("long"), "leaf": F.lit(0).cast("long")}
    several = F.col("last_slab") > 0
    blocks = _in_blocks(slabs, size).groupBy("block")
    found = blocks.applyInArrow(lambda t: _block_tails(t, size, turns), "conv long, slab long, repeated long, leaf long")
    found = written(found, new_scratch(spark, "tails"))
    after = Window.partitionBy("conv").orderBy(F.desc("slab"))
    tail = F.sum("repeated").over(after) - F.col("repeated")
    # A conversation ends in its last slab, which is the first here.
    found = found.select("conv", "slab", tail.alias("tail"), F.first("leaf").over(after).alias("leaf"))
    joined = slabs.where(several).join(found, ["conv", "slab"], "left")
    return slabs.where(~several).withColumns(none).unionByName(joined)


def _ends(rows: DataFrame) -> DataFrame:
    """The digest of the ids of each prefix, in order, comma-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done, ids = [], batch.column(LANES + 1).to_pylist()
            for *key, conv in zip(*(batch.column(i).to_pylist() for i in range(LANES + 1)), ids):
                if key != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield from out(done)
        if now is not None:
            yield from out([(*now, digest.hexdigest())])

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["depth", *PREFIX, "ends"])

    key = ["depth", *PREFIX]
    dealt = rows.select(*key, "conv_id").repartition(*key).sortWithinPartitions(*key, "conv_id")
    return dealt.mapInArrow(run, ", ".join([*(f"{c} long" for c in key), "ends string"]))


def trie(turns: DataFrame, convs: DataFrame, slab: int = SLAB, block: int = BLOCK) -> DataFrame:
    """One row per different prefix of the conversations, the root included.

    ``turns`` has (conv, at, digest, words), ``at`` from 0 without gaps, ``convs`` (conv, n_turns).
    """
    spark = turns.sparkSession
    slabs = written(_slabs(turns, convs, slab), new_scratch(spark, "numbered"))
    if slabs.agg(F.max("last_slab")).first()[0]:
        slabs = written(_with_tails(slabs, block, slab), new_scratch(spark, "tailed"))
    else:
        slabs = slabs.withColumns({"tail": F.lit(0).cast("long"), "leaf": F.lit(0).cast("long")})
    blocks = _in_blocks(slabs, block).groupBy("block")
    found = blocks.applyInArrow(lambda t: _block_nodes(t, block, slab), OUT)
    found = written(found, new_scratch(spark, "nodes"))
    columns = ["depth", *VALUES, "ends_sha256"]
    key = ["depth", *PREFIX]

    parts = found.where(F.col("kind") == PART).groupBy(*key).agg(
        *(F.max(c).alias(c) for c in PARENT),
        *(F.min(c).alias(c) for c in VALUES[:2]),
        *(F.sum(c).alias(c) for c in VALUES[2:]),
    )
    parts = written(parts, new_scratch(spark, "parts"))
    ends = _ends(found.where(F.col("kind") == END))
    ended = parts.join(ends, key, "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends")
    # A parent is looked up by its prefix; one row per prefix, so crowded parents make no pairs.
    up = parts.select((F.col("depth") + 1).alias("depth"), *(F.col(k).alias(p) for k, p in zip(PREFIX, PARENT)), F.col("conv_id").alias("_up"))
    open_ = found.where(F.col("kind") == NO_PARENT).select(*ended.columns).unionByName(ended)
    named = open_.join(up, ["depth", *PARENT], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up"))
    return found.where(F.col("kind") == DONE).select(*columns).unionByName(named.select(*columns))
