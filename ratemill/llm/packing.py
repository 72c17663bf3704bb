"""Packing documents into sequences by best-two-fit (operator 10).

Documents of one length are interchangeable, so the packing is decided on the histogram of piece
lengths, which has at most one entry per possible length whatever the corpus. A bin is filled
greedily with the longest piece that still fits. Then its shortest piece is given back if two
unpacked pieces together fill the gap that opens more tightly. The same bin is repeated as
often as the histogram allows before the next is decided: this gives the bins of the algorithm
run bin by bin. Then every piece finds its bin by its rank among the pieces of its length.

Null text is an empty document and consists of the end id alone. Repeated rows are packed one by
one. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratemill.llm.bpe import load
from ratemill.session import new_scratch, written

# A plan step: the lengths in a bin, in order, and how many bins are filled like that.
Plan = list[tuple[list[int], int]]


def best_two_fit(histogram: dict[int, int], capacity: int) -> Plan:
    """Bins for ``histogram`` (length to number of pieces)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit {capacity}")
        left[length] = n
    plan: Plan = []
    sizes = np.flatnonzero(left)
    while len(sizes):
        greedy = _fill(left, capacity)
        bin_ = _swap_smallest(left, greedy, capacity)
        used, drawn = Counter(bin_), Counter(greedy) | Counter(bin_)
        times = min((int(left[s]) - drawn[s]) // used[s] + 1 if s in used else 1 << 62 for s in drawn)
        for s, n in used.items():
            left[s] -= n * times
        plan.append((sorted(bin_, reverse=True), times))
        sizes = np.flatnonzero(left)
    return plan


def _fill(left: np.ndarray, capacity: int) -> list[int]:
    """The longest piece that fits, again and again."""
    got: list[int] = []
    gap = capacity
    sizes = np.flatnonzero(left)
    at = len(sizes) - 1
    while at >= 0 and gap:
        at = min(at, int(np.searchsorted(sizes, gap, "right")) - 1)
        if at < 0:
            break
        s = int(sizes[at])
        n = min(int(left[s]), gap // s)
        got += [s] * n
        gap -= s * n
        at -= 1
    return got


def _swap_smallest(left: np.ndarray, greedy: list[int], capacity: int) -> list[int]:
    """The bin with its smallest piece replaced by two others, if they fit more tightly."""
    gap = capacity - sum(greedy)
    if not gap or not greedy:
        return greedy
    smallest = min(greedy)
    room = gap + smallest
    free = left.copy()
    for s in greedy:
        free[s] -= 1
    sizes = np.flatnonzero(free[: room + 1])
    best, pair = smallest, None
    for a in sizes[::-1].tolist():
        if 2 * a < best:
            break
        partner = min(a, room - a)
        at = int(np.searchsorted(sizes, partner, "right")) - 1
        if at >= 0 and sizes[at] == a and free[a] < 2:
            at -= 1
        if at >= 0 and a + int(sizes[at]) > best:
            best, pair = a + int(sizes[at]), (a, int(sizes[at]))
    if pair is None:
        return greedy
    kept = sorted(greedy)[1:]
    return [*kept, *pair]


class Slots:
    """For each length, where the pieces of that length go, by their rank."""

    def __init__(self, plan: Plan):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        first_bin = 0
        for lengths, times in plan:
            offset = 0
            for s in lengths:
                by_length.setdefault(s, []).append((first_bin, times, offset, 0))
                offset += s
            first_bin += times
        self.bins = first_bin
        self.table = {}
        for s, rows in by_length.items():
            first, times, offset, _ = (np.array(c, np.int64) for c in zip(*rows))
            self.table[s] = (np.cumsum(times) - times, first, offset)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for s in np.unique(length).tolist():
            rows = np.flatnonzero(length == s)
            before, first, at = self.table[s]
            slot = np.searchsorted(before, rank[rows], "right") - 1
            sequence[rows] = first[slot] + rank[rows] - before[slot]
            offset[rows] = at[slot]
        return sequence, offset


def token_pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut to ``capacity`` from the end.

    ``part`` and ``nth`` tell the task that made the piece and how many of its length came
    before it there; write the table before relying on them.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = load(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            key, columns = [], [[], [], [], [], [], []]
            number, start, length, crc, nth, raw = columns
            for first, ids, counts in bpe.encode(batch.column(1)):
                ids = ids.astype("<u4")
                stop = np.cumsum(counts)
                for i, (a, b) in enumerate(zip((stop - counts).tolist(), stop.tolist())):
                    doc = np.concatenate([ids[a:b], end])
                    n = len(doc)
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k in range(len(cuts) - 1):
                        piece = doc[cuts[k] : cuts[k + 1]]
                        key.append(first + i)
                        number.append(k)
                        start.append(cuts[k])
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece))
                        nth.append(int(seen[len(piece)]))
                        seen[len(piece)] += 1
                        if with_ids:
                            raw.append(piece.tobytes())
            out = [batch.column(0).take(pa.array(key, pa.int64())), pa.array(number, pa.int32())]
            out += [pa.array(c, pa.int64()) for c in (start, length, crc, nth)]
            out.append(pa.array([part] * len(key), pa.int32()))
            names = ["key", "piece", "start", "length", "ids_crc32", "nth", "part"]
            if with_ids:
                out.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = f"key {id_type}, piece int, start long, length long, ids_crc32 long, nth long, part int"
    rows = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return rows.mapInArrow(pieces, schema + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its place there.

    The pieces are written to the shared scratch folder first, since their ranks rest on which
    task made them. The driver holds the histogram of lengths and the plan made of it, both
    bounded by ``capacity``.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, id_col, text_col, vocabulary, end_id, capacity, with_ids), new_scratch(spark, "pieces"))
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = Slots(best_two_fit(histogram, capacity))

    # Pieces of one length in earlier parts come first.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            sequence, offset = slots.place(batch.column("length").to_numpy(), rank)
            kept = batch.drop_columns(["rank"])
            arrays = [*kept.columns, pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept.schema.names, "sequence_id", "offset"])

    ranked = pieces.join(base, ["part", "length"])
    columns = ["key", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*columns, (F.col("base") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    out = ranked.mapInArrow(place, schema + ", sequence_id long, offset long")
    return out.withColumnRenamed("key", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences (``with_ids``): at most ``capacity`` little-endian ids each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
