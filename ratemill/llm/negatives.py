"""Hard negatives from an inverted multi-index (operator 13).

The vectors are cut in halves. Each half has a codebook, learned from a bounded sample; a row lies
in the cell of its two nearest codewords. All rows are indexed and each codeword's radius is the
largest distance of any row's half from it, so that codeword and radius bound what a half can add
to a score. An anchor visits the cells by the sum of the two bounds, largest first, with a heap
over the two sorted sequences, and stops where the next bound is below what it still needs.

1. A few cells give every anchor so many rows of its label that their last score is a floor;
   the cells with bounds at or above it hold all rows that can be among its positives.
2. The positives fix the windows of the negatives. The same few cells give each window a floor,
   and the cells at or above the least floor of an anchor complete its windows.

Anchors go in passes of a bounded number. A pass is sent to every task, which reads the visited
cells of the index, scores its rows against the anchors that visit them and keeps the best few
for each; these are ranked by anchor. Scores are whole numbers and exact, also where they leave the
range in which doubles are.

Rows with a null id or label, a null vector, or a component that is null or not finite take no
part. A vector that is shorter than others counts as if zeros followed. Numbers that leave the
range of a long are taken as its ends. Ties go to the smaller id. Repeated rows are rows of their
own: an equal row is an anchor's positive like any other, and an anchor that stands twice gets its
rows twice. An empty table, or one without anchors, gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratemill.operators.ids import assign_ids
from ratemill.session import new_scratch, written

# Bounds of the index: codewords of a half, rows they are learned from, rounds of learning.
CODES = 16
SAMPLE_ROWS = 4_096
ROUNDS = 10
# Rows in the cells an anchor visits to find its floors.
FIRST_ROWS = 4_096
# Anchors sent to the tasks at once, and scores worked out at once in a task.
PASS_ANCHORS = 16_384
TILE = 1 << 21
EXACT = 2.0**53
LEAST = np.iinfo(np.int64).min
OUT = "n long, slot int, anchor_id long, positive_id long, positive_score long, id long, score long"


@dataclass(frozen=True)
class Rule:
    """``positives`` of a label for each anchor, ``negatives`` for each of them, whose score is
    ``low`` to ``high`` hundredths of the positive's."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100

    def window(self, score: int) -> tuple[int, int]:
        """Least and greatest score of a negative."""
        return -(-self.low * score // 100), self.high * score // 100


@dataclass
class Index:
    """Codebooks of the halves, radii of their codewords, rows of every cell."""

    books: tuple[np.ndarray, np.ndarray]
    dim: int
    radii: tuple[np.ndarray, np.ndarray] | None = None
    rows: np.ndarray | None = None

    def halves(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.books[0].shape[1]
        return q[:, :cut].astype(float), q[:, cut:].astype(float)

    def assign(self, q: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Cell of each row, and the distances of its halves from their codewords."""
        codes, far = [], []
        for x, book in zip(self.halves(q), self.books):
            code = _nearest(x, book)
            codes.append(code)
            far.append(np.sqrt(((x - book[code]) ** 2).sum(axis=1)))
        return codes[0] * len(self.books[1]) + codes[1], far

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """What a half of any row of a codeword can add to the score of ``q`` at most."""
        out = []
        for x, book, radius in zip(self.halves(q), self.books, self.radii):
            size = np.sqrt((x**2).sum(axis=1))[:, None]
            reach = size * (np.sqrt((book**2).sum(axis=1)) + radius)
            out.append(x @ book.T + size * radius + 1e-9 * reach + 1e-3)
        return out

    def visit(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, cell) of the cells with rows, by falling sum of the two bounds."""
        a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
        x, y = left[a].tolist(), right[b].tolist()
        a, b = a.tolist(), b.tolist()
        # The place in the second sequence up to which each place of the first was visited; a
        # cell enters the heap when its neighbours before it in both sequences have left it.
        done = [0] * (len(a) + 1)
        heap = [(-(x[0] + y[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            done[i] = j + 1
            cell = a[i] * len(b) + b[j]
            if self.rows[cell]:
                yield -bound, cell
            if i + 1 < len(a) and done[i + 1] == j:
                heapq.heappush(heap, (-(x[i + 1] + y[j]), i + 1, j))
            if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))

    def needed(self, q: np.ndarray, floors: np.ndarray | None) -> np.ndarray:
        """For each row of ``q`` whether it visits each cell: the first ones, or with a floor
        those whose bound is not below it."""
        left, right = self.bounds(q)
        need = np.zeros((len(q), len(self.rows)), bool)
        for k in range(len(q)):
            seen = 0
            for bound, cell in self.visit(left[k], right[k]):
                if max(bound, LEAST) < floors[k] if floors is not None else seen >= FIRST_ROWS:
                    break
                need[k, cell] = True
                seen += int(self.rows[cell])
        return need


def _nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book**2).sum(axis=1) - 2 * x @ book.T).argmin(axis=1)


def codebook(x: np.ndarray, codes: int) -> np.ndarray:
    """At most ``codes`` codewords of the rows of ``x``, from its first different rows on."""
    _, first = np.unique(x, axis=0, return_index=True)
    book = x[np.sort(first)[:codes]].astype(float)
    for _ in range(ROUNDS):
        near = _nearest(x, book)
        n = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
    return book


def vectors(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists as a matrix, short ones filled with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows, exact: as doubles where these hold them, else as longs."""
    x, y = a.astype(float), b.astype(float)
    if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * a.shape[1] < EXACT:
        return x @ y.T
    whole = a.astype(object) @ b.T.astype(object)
    return np.clip(whole, LEAST, np.iinfo(np.int64).max).astype(np.int64)


def best(scores: np.ndarray, wanted: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` best wanted scores of every row; ties go to smaller ids."""
    if scores.shape[1] > k:
        least = -np.inf if scores.dtype.kind == "f" else LEAST
        kth = np.partition(np.where(wanted, scores, least), -k, axis=1)[:, -k]
        wanted = wanted & (scores >= kth[:, None])
    row, column = np.nonzero(wanted)
    found = scores[row, column].astype(np.int64)
    order = np.lexsort((ids[column], ~found, row))
    row, column = row[order], column[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < k], column[nth < k]


@dataclass
class Pass:
    """Anchors of one pass. ``slots`` are lists of (anchor, least, greatest) score with the
    positive it is for, or of positives still to be found."""

    n: np.ndarray
    id: np.ndarray
    label: np.ndarray
    q: np.ndarray
    need: np.ndarray
    same_label: bool
    keep: int
    slots: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _scan(rows: DataFrame, index: Index, anchors: Pass) -> DataFrame:
    """The best rows of every anchor and slot of each task's part of the cells."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)
    dim = index.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            labels = batch.column(1).to_numpy()
            q = vectors(batch.column(2), dim)
            cells = batch.column(3).to_numpy()
            for cell in np.unique(cells).tolist():
                at = np.flatnonzero(cells == cell)
                who = np.flatnonzero(own.need[:, cell])
                for first in range(0, len(who), step := max(1, TILE // len(at))):
                    yield from tile(own, who[first : first + step], ids[at], labels[at], q[at])

    def tile(own: Pass, who: np.ndarray, ids: np.ndarray, labels: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        scores = products(own.q[who], q)
        label_fits = (own.label[who][:, None] == labels) == own.same_label
        for slot, (there, low, high, pos_id, pos_score) in enumerate(own.slots):
            k = np.flatnonzero(there[who])
            a = who[k]
            wanted = label_fits[k] & (scores[k] >= low[a][:, None]) & (scores[k] <= high[a][:, None])
            row, column = best(scores[k], wanted, ids, own.keep)
            if len(row):
                of = a[row]
                score = scores[k[row], column].astype(np.int64)
                values = [own.n[of], np.full(len(of), slot, np.int32), own.id[of], pos_id[of], pos_score[of], ids[column], score]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names)

    names = [part.split()[0] for part in OUT.split(", ")]
    visited = np.flatnonzero(anchors.need.any(axis=0)).tolist()
    read = rows.where(F.col("cell").isin(visited)).select("id", "label", "q", "cell")
    found = read.mapInArrow(run, OUT)
    place = F.row_number().over(Window.partitionBy("n", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= anchors.keep)


def _needed(spark: SparkSession, index: Index, n: np.ndarray, q: np.ndarray, floors: np.ndarray | None) -> np.ndarray:
    """:meth:`Index.needed`, worked out by tasks."""
    dim = index.dim
    shared = spark.sparkContext.broadcast((index, q, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors_, floors_ = shared.value
        for batch in batches:
            at = batch.column(0).to_numpy()
            need = own.needed(vectors_[at].reshape(-1, dim), None if floors_ is None else floors_[at])
            bits = [row.tobytes() for row in np.packbits(need, axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits, pa.binary())], ["id", "bits"])

    tasks = max(1, min(spark.sparkContext.defaultParallelism, len(n)))
    rows = spark.range(0, len(n), 1, tasks).mapInArrow(run, "id long, bits binary").collect()
    out = np.zeros((len(n), len(index.rows)), bool)
    for row in rows:
        out[row.id] = np.unpackbits(np.frombuffer(row.bits, np.uint8))[: len(index.rows)]
    return out


def build(rows: DataFrame, codes: int = CODES, sample_rows: int = SAMPLE_ROWS) -> tuple[Index, DataFrame]:
    """The index over ``rows`` (id, label, q, is_anchor), and its rows by cell, written.

    The driver holds the sample, the codebooks and one entry per cell.
    """
    spark = rows.sparkSession
    dim = rows.agg(F.coalesce(F.max(F.size("q")), F.lit(0))).first()[0]
    sample = rows.select("id", "q").orderBy(F.xxhash64("id"), "id", "q").limit(sample_rows).toArrow()
    column = sample.column("q").combine_chunks()
    q = vectors(column, dim).astype(float)
    cut = dim // 2
    index = Index((codebook(q[:, :cut], codes), codebook(q[:, cut:], codes)), dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = index.assign(vectors(batch.column(2), dim))
            arrays = [*batch.columns, pa.array(cell.astype(np.int32)), *map(pa.array, far)]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "cell", "far_1", "far_2"])

    schema = "id long, label long, q array<long>, is_anchor boolean, cell int, far_1 double, far_2 double"
    placed = written(rows.mapInArrow(assign, schema), new_scratch(spark, "cells"))
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far_1").alias("a"), F.max("far_2").alias("b")).collect()
    n1, n2 = map(len, index.books)
    index.rows = np.zeros(n1 * n2, np.int64)
    index.radii = (np.zeros(n1), np.zeros(n2))
    for r in cells:
        index.rows[r.cell] = r.n
        for radius, code, far in zip(index.radii, divmod(r.cell, n2), (r.a, r.b)):
            radius[code] = max(radius[code], far)
    # By cell, and within a cell by place, so that a crowded cell spreads over partitions.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_cell = placed.drop("far_1", "far_2").withColumn("_at", F.monotonically_increasing_id())
    by_cell = by_cell.repartitionByRange(parts, "cell", "_at").sortWithinPartitions("cell", "_at").drop("_at")
    return index, written(by_cell, new_scratch(spark, "index"))


def mine(
    table: DataFrame, id_col: str, label: Column, vector_col: str, is_anchor: Column, rule: Rule = Rule(), scale: int = 256, pass_anchors: int = PASS_ANCHORS
) -> DataFrame:
    """The negatives of every anchor and positive, ranked.

    ``label`` is a whole number; a component x becomes floor(scale * x).
    """
    spark = table.sparkSession
    vector = F.transform(vector_col, lambda x: x.cast("double"))
    rows = table.select(table[id_col].cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("v"), is_anchor.alias("is_anchor"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~odd)
    q = F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("q")
    rows = rows.select("id", "label", q, F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"))
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if rows.isEmpty():
        return spark.createDataFrame([], columns)
    index, by_cell = build(rows)
    anchors = by_cell.where("is_anchor").select("id", "label", "q", "cell")
    numbered = assign_ids(anchors, ["cell", "id", "label", "q"], -1, "n").withColumn("pass", F.floor(F.col("n") / pass_anchors))
    numbered = written(numbered, new_scratch(spark, "anchors"))
    passes = numbered.agg(F.max("pass")).first()[0]
    if passes is None:
        return spark.createDataFrame([], columns)
    out = new_scratch(spark, "negatives")
    for k in range(passes + 1):
        _mine_pass(spark, index, by_cell, numbered.where(F.col("pass") == k), rule, f"{out}/pass={k}")
    found = spark.read.schema(f"{OUT}, rank int").parquet(*[f"{out}/pass={k}" for k in range(passes + 1)])
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _mine_pass(spark: SparkSession, index: Index, by_cell: DataFrame, anchors: DataFrame, rule: Rule, path: str) -> None:
    """Write the negatives of the anchors of one pass; the driver holds these anchors."""
    own = anchors.orderBy("n").toArrow().combine_chunks()
    n, ids, labels = (own.column(c).to_numpy() for c in ("n", "id", "label"))
    q = vectors(own.column("q").combine_chunks(), index.dim)
    count, none = len(n), np.full(len(n), LEAST)
    most, everyone = np.full(count, np.iinfo(np.int64).max), np.ones(count, bool)
    first = _needed(spark, index, n, q, None)

    def positives(need: np.ndarray, low: np.ndarray) -> list[list[tuple[int, int]]]:
        # One more than asked for, since the anchor itself is a row of its label.
        scan = Pass(n, ids, labels, q, need, True, rule.positives + 1, [(everyone, low, most, none, none)])
        out: list[list[tuple[int, int]]] = [[] for _ in range(count)]
        for r in _scan(by_cell, index, scan).select("n", "score", "id", "rank").orderBy("n", "rank").collect():
            out[r.n - n[0]].append((r.score, r.id))
        return out

    def floors(found: list[list[tuple[int, int]]], wanted: int) -> np.ndarray:
        return np.array([f[-1][0] if len(f) == wanted else LEAST for f in found], np.int64)

    low = floors(positives(first, none), rule.positives + 1)
    found = positives(_needed(spark, index, n, q, low), low)
    itself = [int(products(v[None], v[None])[0, 0]) for v in q]
    for k, f in enumerate(found):
        if (itself[k], ids[k]) in f:
            f.remove((itself[k], ids[k]))
        del f[rule.positives :]

    slots = []
    for s in range(rule.positives):
        there = np.array([len(f) > s for f in found])
        windows = [rule.window(f[s][0]) if len(f) > s else (0, 0) for f in found]
        score, positive = (np.array([f[s][x] if len(f) > s else 0 for f in found], np.int64) for x in (0, 1))
        slots.append((there, *(np.array(w, np.int64) for w in zip(*windows)), positive, score))
    scan = Pass(n, ids, labels, q, first, False, rule.negatives, slots)
    last = _scan(by_cell, index, scan).where(F.col("rank") == rule.negatives)
    for r in last.select("n", "slot", "score").collect():
        low = slots[r.slot][1]
        low[r.n - n[0]] = max(low[r.n - n[0]], r.score)
    # An anchor needs what its lowest window needs; one without positives visits nothing.
    least = np.min([np.where(there, low, most) for there, low, *_ in slots], axis=0)
    scan.need = _needed(spark, index, n, q, least)
    scan.need &= np.any([there for there, *_ in slots], axis=0)[:, None]
    _scan(by_cell, index, scan).write.parquet(path)
