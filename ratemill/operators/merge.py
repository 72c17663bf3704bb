"""Keyed merge of a batch into a table, with row-by-row semantics as set operations.

The batch behaves as if its rows were merged one at a time in ``order``: the last row of a key
wins, insert-only columns keep the first, and every row has an action of its own.

Skew: a key may hold a large share of either side. Batch rows are collapsed per key with a
map-side partial aggregate, target rows are reduced to one row per key the same way before they
meet the batch, the one join that keeps every target row has a unique right side (adaptive
execution can split its left side), and the window over a hot key's rows runs in chunks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratemill.functions.convert import strict_int
from ratemill.operators.ids import assign_ids, placed_rows
from ratemill.session import BROADCAST_HASHES, BROADCAST_ROWS, new_scratch, written

INSERT, UPDATE, UNCHANGED = "INSERT", "UPDATE", "UNCHANGED"

# A key of a batch is hot above HOT_ROWS rows, or above one HOT_KEYS-th of the batch if that is
# more. So there are fewer than HOT_KEYS hot keys whatever the data.
HOT_ROWS = 1_000_000
HOT_KEYS = 100_000

# Up to so many hashes are told apart by a table of bits, of 64 to 128 MB at the most; bits for each hash
# at least; words of 64 bits in a row of that table, as a power of two.
MARKED_HASHES = 32_000_000
BITS_EACH = 16
SLICE_BITS = 9


@dataclass(frozen=True)
class MergeRule:
    """Which columns identify a row and which of the others a match updates."""

    key: tuple[str, ...]
    columns: tuple[str, ...]
    insert_only: tuple[str, ...] = ()
    update_when: str = "always"
    key_collation: str | None = None
    integer_keys: tuple[str, ...] = ()
    text_keys: tuple[str, ...] = ()

    @property
    def rewritten(self) -> dict[str, Column]:
        """Key columns that are not compared as they are: as integer, or under a collation."""
        out = {k: strict_int(F.col(k).cast("string")) for k in self.integer_keys}
        if self.key_collation:
            out |= {k: F.collate(F.col(k), self.key_collation) for k in self.text_keys}
        return out

    @property
    def match(self) -> list[str]:
        """Names of the compared columns after :func:`with_match`."""
        return [f"_match_{k}" if k in self.rewritten else k for k in self.key]

    @property
    def kept(self) -> list[str]:
        """Columns the first row of a new key fixes: insert-only ones, and keys that can be
        equal without being identical."""
        return [c for c in self.columns if c in self.insert_only or c in self.rewritten]

    @property
    def updated(self) -> list[str]:
        return [c for c in self.columns if c not in self.kept and c not in self.key]


def with_match(df: DataFrame, rule: MergeRule) -> DataFrame:
    """``df`` with the columns keys are compared on."""
    return df.withColumns({f"_match_{k}": c for k, c in rule.rewritten.items()})


def with_hash(df: DataFrame, match: list[str]) -> DataFrame:
    """``df`` with ``_hash`` of the compared columns, NULL where one of them is: such a row
    matches nothing."""
    known = F.lit(True)
    for m in match:
        known = known & F.col(m).isNotNull()
    return df.withColumn("_hash", F.when(known, F.xxhash64(*match)))


def hashes(df: DataFrame, match: list[str]) -> DataFrame:
    """The different hashes of the keys of ``df``."""
    return with_hash(df, match).where("_hash IS NOT NULL").select("_hash").distinct()


def _bit_place(n_bits: int) -> tuple[Column, Column, Column]:
    """Where the bit of ``_hash`` is: the slice, the word in it, and the bit of the word."""
    place = F.col("_hash").bitwiseAND(n_bits - 1)
    word = F.shiftright(place, 6)
    return F.shiftright(word, SLICE_BITS), word.bitwiseAND((1 << SLICE_BITS) - 1).cast("int"), place.bitwiseAND(63).cast("int")


def marks(some: DataFrame, n: int, path: str) -> DataFrame:
    """What :func:`parted` takes for ``n`` hashes, written to ``path``: the hashes, or if they are
    many a table of bits of which theirs are set. That has 2 to 4 bytes a hash instead of the 50
    or so of a hash table, and one in 16 to 32 of other hashes meets a bit that is set."""
    if n <= BROADCAST_ROWS:
        return written(some, path)
    n_bits = 1 << (n * BITS_EACH - 1).bit_length()
    slices, word, bit = _bit_place(n_bits)
    all_words = some.sparkSession.range(n_bits >> 6).select(
        F.shiftright("id", SLICE_BITS).alias("_slice"),
        F.col("id").bitwiseAND((1 << SLICE_BITS) - 1).cast("int").alias("_word"),
        F.lit(0).cast("long").alias("_bits"),
    )
    set_bits = some.select(slices.alias("_slice"), word.alias("_word"), bit.alias("_bit"))
    set_bits = set_bits.select("_slice", "_word", F.expr("shiftleft(1L, _bit)").alias("_bits"))
    words = all_words.unionByName(set_bits).groupBy("_slice", "_word").agg(F.bit_or("_bits").alias("_bits"))
    in_order = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
    table = words.groupBy("_slice").agg(in_order.alias("_words"))
    return written(table.select("_slice", F.col("_words._bits").alias("_words"), F.lit(n_bits).alias("_n_bits")), path)


def parted(df: DataFrame, match: list[str], some: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key has one of the hashes ``some``, among them all rows of the keys these
    were made of, and the other rows. No row is shuffled: ``some`` is broadcast, so it must have
    at most ``BROADCAST_HASHES`` rows, or be made by :func:`marks`; then the first rows are joined
    by a few whose keys are none of these."""
    hashed, some = with_hash(df, match), F.broadcast(some)
    if "_words" in some.columns:
        n_bits = some.first()["_n_bits"]
        slices, word, bit = _bit_place(n_bits)
        found = hashed.withColumn("_slice", slices).join(some.drop("_n_bits"), "_slice", "left")
        is_set = F.coalesce(F.expr("getbit(_words[_word], _bit)") == 1, F.lit(False))
        found = found.withColumns({"_word": word, "_bit": bit})
        return tuple(found.where(c).select(*df.columns) for c in (is_set, ~is_set))
    inside, outside = (hashed.join(some, "_hash", how).select(*df.columns) for how in ("left_semi", "left_anti"))
    return inside, outside


def matched_rows(rows: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key ``other`` has (J1). ``other`` is reduced to its keys first, so a key that
    repeats on both sides makes no pairs and no crowded partition."""
    return rows.join(other.select(*key).distinct(), key, "left_semi")


def rows_differ(left: list[Column], right: list[Column]) -> Column:
    """Whether any pair of values differs; two NULLs are equal."""

    def as_struct(values: list[Column]) -> Column:
        return F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])

    return ~as_struct(left).eqNullSafe(as_struct(right))


def key_states(target: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Per key ``_low`` and ``_high``, structs of the least and greatest value of every column in
    its target rows; a low value is NULL if any is.

    All rows of a key equal some values exactly if both bounds do. One row per key, reduced
    before the shuffle, stands for any number of target rows. Column by column, so that columns
    of numbers and dates are hashed and not sorted.
    """
    if not columns:
        return target.groupBy(*key).agg(F.count("*").alias("_n")).select(*key, _one("_low"), _one("_high"))
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(columns):
        aggs += [F.min(c).alias(f"_min_{i}"), F.max(c).alias(f"_max_{i}"), F.count(c).alias(f"_n_{i}")]
    found = target.groupBy(*key).agg(*aggs)
    low = [F.when(F.col(f"_n_{i}") == F.col("_n"), F.col(f"_min_{i}")).alias(c) for i, c in enumerate(columns)]
    high = [F.col(f"_max_{i}").alias(c) for i, c in enumerate(columns)]
    return found.select(*key, F.struct(*low).alias("_low"), F.struct(*high).alias("_high"))


def _one(name: str) -> Column:
    return F.struct(F.lit(1).alias("one")).alias(name)


def _differs_from_state(values: Column) -> Column:
    return rows_differ([F.col("_low"), F.col("_high")], [values, values])


def changed_rows(batch: DataFrame, target: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Batch rows whose key has a target row with other values."""
    values = F.struct(*columns)
    met = matched_rows(target, batch, key)
    found = batch.join(key_states(met, key, columns), key)
    return found.where(_differs_from_state(values)).select(*batch.columns)


def new_rows(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Batch rows whose key the target does not have."""
    return batch.join(target.select(*key).distinct(), key, "left_anti")


def untouched_rows(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Target rows whose key the batch does not name."""
    return target.join(batch.select(*key).distinct(), key, "left_anti")


def _order(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def collapse_batch(batch: DataFrame, rule: MergeRule, order: list[str]) -> DataFrame:
    """One row per key (M5): updated columns of the last row, kept columns of the first,
    ``_first`` the order of the first row, ``_n`` the number of rows.

    A plain aggregate, so a hot key leaves each map task as one row.
    """
    at = _order(order)
    aggs = [F.min(at).alias("_first"), F.count("*").alias("_n")]
    if rule.updated:
        aggs.append(F.max_by(F.struct(*rule.updated), at).alias("_last_row"))
    if rule.kept:
        aggs.append(F.min_by(F.struct(*rule.kept), at).alias("_first_row"))
    grouped = with_match(batch, rule).groupBy(*rule.match).agg(*aggs)
    columns = [
        F.col("_first_row")[c].alias(c)
        if c in rule.kept
        else F.col("_last_row")[c].alias(c)
        if c in rule.updated
        else F.col(c)
        for c in rule.columns
    ]
    extra = [m for m in rule.match if m not in rule.key]
    return grouped.select(*columns, *extra, "_first", "_n")


def repeated_keys(batch: DataFrame, rule: MergeRule) -> DataFrame:
    """Keys with more than one row, and how many: a count over the key columns only."""
    counts = with_match(batch, rule).groupBy(*rule.match).agg(F.count("*").alias("_n"))
    return counts.where("_n > 1")


def collapse_around(
    batch: DataFrame,
    rule: MergeRule,
    order: list[str],
    repeated: DataFrame,
    n_repeated: int,
    marked: DataFrame | None = None,
) -> DataFrame:
    """:func:`collapse_batch` where the repeated keys are known.

    The rows of all other keys pass through, and no whole row is shuffled for them: the hashes of
    the repeated keys are broadcast, or ``marked``, the :func:`marks` of them. A key that only
    shares a hash is collapsed too, to the same row. If they are too many, or compared under a collation, whose equal values differ in their
    hash, Spark broadcasts the keys if their bytes allow; ``repeated`` should be written. Else the
    plain aggregate does the work.
    """
    hashed = (n_repeated <= BROADCAST_HASHES or marked is not None) and not rule.key_collation
    if n_repeated > BROADCAST_ROWS and not hashed:
        return collapse_batch(batch, rule, order)
    keyed = with_match(batch, rule)
    single = again = keyed
    if n_repeated and hashed:
        some = hashes(repeated, rule.match) if marked is None else marked
        again, single = parted(keyed, rule.match, some)
    elif n_repeated:
        keys = repeated.select(*rule.match)
        again, single = (keyed.join(keys, rule.match, how) for how in ("left_semi", "left_anti"))
    extra = [m for m in rule.match if m not in rule.key]
    single = single.select(
        *rule.columns, *extra, _order(order).alias("_first"), F.lit(1).cast("long").alias("_n")
    )
    if not n_repeated:
        return single
    return single.unionByName(collapse_batch(again.select(*batch.columns), rule, order))


def _matched_table(target: DataFrame, collapsed: DataFrame, rule: MergeRule) -> DataFrame:
    """All target rows after the batch, and ``_hit``, whether the row's key is in ``collapsed``.

    Every target row of a key is updated. The right side is unique per key: Spark broadcasts it
    if it measures small, and else can split a skewed target partition.
    """
    source = collapsed.select(
        *rule.match, F.struct(*rule.updated).alias("_new") if rule.updated else F.lit(1).alias("_new")
    )
    joined = with_match(target, rule).join(source, rule.match, "left")
    found = F.col("_new").isNotNull()
    return joined.select(
        *[
            F.when(found, F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in rule.updated
            else F.col(c)
            for c in target.columns
        ],
        found.alias("_hit"),
    )


def update_matched(target: DataFrame, collapsed: DataFrame, rule: MergeRule) -> DataFrame:
    """All target rows; those whose key is in ``collapsed`` carry its values."""
    return _matched_table(target, collapsed, rule).select(*target.columns)


def upsert(
    target: DataFrame, batch: DataFrame, rule: MergeRule, order: list[str], id_col: str | None = "ID"
) -> DataFrame:
    """The target after the batch (M1-M3). New rows get ids after the greatest one, in order of
    first appearance (M8).

    The target is read once, in the join that updates it; the joined rows are written, and the
    keys that matched and the greatest id are read from their columns. An update on change gives
    the same table as an update always; the two differ in :func:`merge_actions`. Keys must not be
    NULL (a NULL key is a constraint violation).
    """
    spark = batch.sparkSession
    collapsed = collapse_batch(batch, rule, order).select(*rule.columns, "_first", "_n")
    collapsed = with_match(written(collapsed, new_scratch(spark, "collapsed")), rule)
    merged = written(_matched_table(target, collapsed, rule), new_scratch(spark, "merged"))
    hits = with_match(merged.where("_hit").select(*rule.key), rule)
    new = collapsed.join(hits.select(*rule.match).distinct(), rule.match, "left_anti")
    kept = merged.select(*target.columns)
    if id_col is None:
        return kept.unionByName(new.select(*rule.columns))
    start = merged.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    new = assign_ids(new.select(*rule.columns, "_first"), ["_first"], start, id_col)
    return kept.unionByName(new.select(*rule.columns, id_col))


def hot_keys(
    batch: DataFrame, match: list[str], n_rows: int, hot_rows: int, max_keys: int = HOT_KEYS
) -> DataFrame | None:
    """Keys with more rows than one window should sort, or None if there can be none.

    Each has over ``n_rows / max_keys`` rows, so there are fewer than ``max_keys``.
    """
    if n_rows <= hot_rows:
        return None
    at_least = max(hot_rows, n_rows // max_keys)
    found = batch.groupBy(*match).count().where(F.col("count") > at_least).select(*match)
    return written(found, new_scratch(batch.sparkSession, "hot"))


def merge_actions(
    target: DataFrame,
    batch: DataFrame,
    rule: MergeRule,
    order: list[str],
    chunk: list[Column] | None = None,
    hot_rows: int = HOT_ROWS,
    chunk_parts: int | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Every batch row with its ``_action``: INSERT, UPDATE or UNCHANGED (M4).

    A key's first row meets the target; each later row meets the row before it. The window that
    finds the row before is partitioned by key. The rows of a hot key are cut into chunks along
    the order; the last row of a chunk is carried over to the next one that has the key.

    ``chunk`` are whole numbers that never fall along ``order``. Without them, and with a hot
    key, the batch is range-partitioned along the order, whatever its types, and written; the
    partition is the chunk. ``n_rows`` is the size of the batch if the caller knows it.
    """
    columns = batch.columns
    at, match = _order(order), rule.match
    compare = rule.updated if rule.update_when == "changed" else []
    values = F.struct(*compare) if compare else _one("_values")
    rows = with_match(batch, rule).withColumn("_values", values)
    state = key_states(matched_rows(with_match(target, rule), rows, match), match, compare)

    hot = hot_keys(rows, match, batch.count() if n_rows is None else n_rows, hot_rows)
    group = list(match)
    if hot is not None and chunk is None:
        rows = placed_rows(rows, order, new_scratch(batch.sparkSession, "chunks"), chunk_parts).drop("_place")
        chunk = [F.col("_part")]
    if hot is not None:
        # Fewer than HOT_KEYS rows by construction; written, so Spark knows their bytes.
        rows = rows.join(hot.withColumn("_hot", F.lit(True)), match, "left")
        parts = [f"_chunk_{i}" for i in range(len(chunk))]
        rows = rows.withColumns(
            {
                p: F.when(F.col("_hot"), c.cast("long")).otherwise(F.lit(-1).cast("long"))
                for p, c in zip(parts, chunk)
            }
        )
        group += parts
        # Rows may come partitioned by key alone, which would do for the window below.
        rows = rows.repartition(*group)

    rows = rows.withColumn("_before", F.lag("_values").over(Window.partitionBy(*group).orderBy(at)))
    if hot is None:
        rows = rows.join(state, match, "left")
    else:
        along = Window.partitionBy(*match).orderBy(*parts)
        edges = (
            rows.where("_hot")
            .groupBy(*group)
            .agg(F.max_by("_values", at).alias("_end"))
            .withColumn("_carried", F.lag("_end").over(along))
            .drop("_end")
        )
        # The target state goes to a hot key's first chunk, so rows never meet by key alone.
        heads = edges.where("_carried IS NULL").drop("_carried")
        state = state.join(heads, match, "left").withColumns(
            {p: F.coalesce(F.col(p), F.lit(-1).cast("long")) for p in parts}
        )
        rows = rows.join(edges, group, "left").join(state, group, "left")
        rows = rows.withColumn("_before", F.coalesce("_before", "_carried"))

    first = F.col("_before").isNull()
    differs = (
        F.when(first, _differs_from_state(F.col("_values"))).otherwise(
            ~F.col("_before").eqNullSafe(F.col("_values"))
        )
        if compare
        else F.lit(True)
    )
    action = (
        F.when(first & F.col("_low").isNull(), INSERT).when(differs, UPDATE).otherwise(UNCHANGED)
    )
    return rows.select(*columns, action.alias("_action"))


def count_actions(actions: DataFrame, by: list[str]) -> DataFrame:
    """Rows, inserts, updates and processed rows of each group."""
    action = F.col("_action")
    return actions.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.count_if(action == INSERT).alias("inserted"),
        F.count_if(action == UPDATE).alias("updated"),
        F.count_if(action != UNCHANGED).alias("processed"),
    )
