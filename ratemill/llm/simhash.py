"""SimHash near-duplicates with an inverted index of byte positions (operator 2).

A fingerprint has 64 bits, one per majority of the hashes of a text's shingles. Two fingerprints
that differ in at most ``distance`` bits agree in at least ``8 - distance`` of their bytes. The
index has a posting list for each way to fix some byte positions and their values; the chosen
sets of positions are such that a pair with that many common bytes meets in one list. Inside a
list the common positional bytes of a pair are counted, pairs with too few are dropped, and the
bits of the others are compared.

Equal fingerprints count once. A list with at most ``list_limit`` fingerprints is compared inside
its task and gives at most one link per fingerprint, enough to connect what is connected. The
fingerprints of longer lists are linked over all 64-bit numbers within a bit or two of them,
which takes a fixed number of rows for each (``ball_links``). Both ways are exact.

Null text is empty; an empty text has fingerprint zero and is linked like any other. Rows with
equal ids stay apart. A null id never names a component unless all ids of the component are null.
Texts of any length are hashed whole, a bounded number of shingles at a time. An empty table
gives no rows. Extra columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill.llm.components import components
from ratemill.llm.segments import text_bytes
from ratemill.session import new_scratch, written

SEED = 42
TEXT_BLOCK = 1 << 20
HASH_BLOCK = 1 << 16
LIST_LIMIT = 16_384
SMALL_RUN = 32
PAIR_BLOCK = 1 << 22
BYTES = 8


def _shingle_hashes(raw: bytes, shingle: int) -> Iterator[list[int]]:
    """Hashes of all shingles of a text, a bounded number at a time."""
    tail: list[bytes] = []
    at, n_words = 0, 0
    digest = xxhash.xxh64_intdigest
    while at < len(raw):
        stop = at + TEXT_BLOCK
        while stop < len(raw) and not raw[stop : stop + 1].isspace():
            stop += 1
        words = tail + raw[at:stop].lower().split()
        at = stop
        n_words += len(words) - len(tail)
        if n_words >= shingle and len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = (ends - [len(w) + 1 for w in words])[: len(words) - shingle + 1].tolist()
            yield [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
            tail = words[len(words) - shingle + 1 :]
        else:
            tail = words
    if 0 < n_words < shingle:
        yield [digest(b" ".join(tail), SEED)]


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, BYTES), axis=1).sum(0, dtype=np.int64)


def _fingerprints(raw: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    """Fingerprints as signed 64-bit numbers."""
    n = len(offsets) - 1
    body = raw.tobytes()
    out = np.zeros(n, np.uint64)
    pending: list[int] = []
    owners: list[tuple[int, int]] = []

    def settle() -> None:
        if owners:
            bits = np.unpackbits(np.array(pending, np.uint64).astype(">u8").view(np.uint8).reshape(-1, BYTES), axis=1)
            sizes = np.array([k for _, k in owners])
            sums = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32)
            out[[i for i, _ in owners]] = _majority(sums, sizes)
            pending.clear()
            owners.clear()

    for i in range(n):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        if hi - lo > TEXT_BLOCK:
            sums, count = np.zeros(64, np.int64), 0
            for part in _shingle_hashes(body[lo:hi], shingle):
                sums += _bit_sums(np.array(part, np.uint64))
                count += len(part)
            if count:
                out[i] = _majority(sums[None, :], np.array([count]))[0]
            continue
        before = len(pending)
        for part in _shingle_hashes(body[lo:hi], shingle):
            pending += part
        if len(pending) > before:
            owners.append((i, len(pending) - before))
        if len(pending) >= HASH_BLOCK:
            settle()
    settle()
    return out.view(np.int64)


def _majority(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    bits = 2 * sums > sizes[:, None]
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(key, fp): the fingerprint of every row as a signed number."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_fingerprints(raw, offsets, shingle))], ["key", "fp"])

    rows = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return rows.mapInArrow(compute, f"key {id_type}, fp long")


def position_sets(common: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which every ``common`` positions contain one.

    Triples inside two halves of the positions: five positions have three in one half. Fewer
    common bytes use single positions in the same way.
    """
    halves = (range(BYTES // 2), range(BYTES // 2, BYTES))
    size = min(3, (common + 1) // 2)
    return [s for half in halves for s in combinations(half, size)]


def _postings(fps: DataFrame, common: int) -> DataFrame:
    """(key, fp): the set's number and the bytes at its positions."""

    def byte(at: int) -> Column:
        return F.shiftrightunsigned("fp", 8 * (BYTES - 1 - at)).bitwiseAND(0xFF)

    keys = []
    for number, positions in enumerate(position_sets(common)):
        key = F.lit(number).cast("long")
        for at in positions:
            key = key * 256 + byte(at)
        keys.append(key)
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, for nodes 0..n-1."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        on = ra != rb
        a, b, ra, rb = a[on], b[on], ra[on], rb[on]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _near(x: np.ndarray, y: np.ndarray, common: int, distance: int) -> np.ndarray:
    """Count the common positional bytes, then compare the bits of those with enough."""
    differ = x ^ y
    shared = (differ.view(np.uint8).reshape(*differ.shape, BYTES) == 0).sum(-1, dtype=np.uint8)
    near = shared >= common
    near[near] = np.bitwise_count(differ[near]) <= distance
    return near


def _links_of_runs(fp: np.ndarray, run: np.ndarray, common: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of equal run number; runs lie together."""
    starts = np.flatnonzero(np.diff(run, prepend=run[0] - 1))
    sizes = np.diff(starts, append=len(run))
    a, b = [], []
    alone = np.repeat(sizes <= SMALL_RUN, sizes)
    for step in range(1, min(SMALL_RUN, int(sizes.max(initial=0)))):
        left = np.flatnonzero((run[:-step] == run[step:]) & alone[:-step])
        if not len(left):
            break
        left = left[_near(fp[left], fp[left + step], common, distance)]
        a.append(left)
        b.append(left + step)
    for start, size in zip(starts[sizes > SMALL_RUN].tolist(), sizes[sizes > SMALL_RUN].tolist()):
        own = fp[start : start + size]
        rows = max(1, PAIR_BLOCK // size)
        root = np.arange(size)
        for at in range(0, size, rows):
            i, j = np.nonzero(_near(own[at : at + rows, None], own[None, at:], common, distance))
            on = root[i + at] != root[j + at]
            i, j = i[on] + at, j[on] + at
            merged = _roots(size, np.concatenate([np.arange(size), i]), np.concatenate([root, j]))
            root = merged
        a.append(np.arange(start, start + size)[root != np.arange(size)])
        b.append(start + root[root != np.arange(size)])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    root = _roots(len(fp), a, b)
    rows = np.flatnonzero(root != np.arange(len(fp)))
    return rows, root[rows]


def _list_links(postings: DataFrame, common: int, distance: int, list_limit: int) -> DataFrame:
    """(a, b) links inside the posting lists; (a, null) for fingerprints of lists over the limit."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            second = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
            return pa.RecordBatch.from_arrays([pa.array(a), second], ["a", "b"])

        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        long_key = None  # the list that is known to be over the limit
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            if long_key is not None:
                n = int(np.searchsorted(key, long_key, "right"))
                yield out(fp[:n], None)
                key, fp = key[n:], fp[n:]
            if not len(key):
                continue
            open_from = int(np.searchsorted(key, key[-1]))
            yield from closed(out, key[:open_from], fp[:open_from])
            key, fp = key[open_from:], fp[open_from:]
            long_key = None
            if len(key) > list_limit:
                long_key = key[0]
                yield out(fp, None)
                key, fp = key[:0], fp[:0]
        if len(key):
            yield from closed(out, key, fp)

    def closed(out, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
        sizes = np.diff(starts, append=len(key))
        over = np.repeat(sizes > list_limit, sizes)
        yield out(fp[over], None)
        kept, run = fp[~over].view(np.uint64), np.repeat(np.arange(len(sizes)), sizes)[~over]
        if len(kept):
            a, b = _links_of_runs(kept, run, common, distance)
            yield out(kept[a].view(np.int64), kept[b].view(np.int64))

    dealt = postings.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(compare, "a long, b long")


def ball_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links among all ``fps`` by meeting points, linear in their number.

    Two numbers within ``distance`` bits have a point within ``near`` bits of the one and ``far``
    bits of the other, near + far = distance. At a point, all are linked to one that is ``near``;
    such a link spans at most ``distance`` bits.
    """
    near, far = distance // 2, distance - distance // 2
    flips = [0]
    for n in range(1, far + 1):
        flips += [sum(1 << i for i in bits) for bits in combinations(range(64), n)]
    masks = np.array(flips, np.uint64).view(np.int64)
    n_near = sum(len(list(combinations(range(64), n))) for n in range(near + 1))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for at in range(0, len(own), 64):
                some = own[at : at + 64]
                points = (some[:, None] ^ masks[None, :]).ravel()
                close = np.tile(np.arange(len(masks)) < n_near, len(some))
                yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(np.repeat(some, len(masks))), pa.array(close)], ["point", "fp", "close"])

    points = fps.mapInArrow(spread, "point long, fp long, close boolean")
    hub = points.where("close").groupBy("point").agg(F.min("fp").alias("hub"))
    met = points.join(hub, "point").where("fp <> hub")
    return met.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, distance: int = 3, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Every row's id, its ``fingerprint`` in 16 hexadecimal digits and its ``component_id``, the
    smallest id reachable over links of at most ``distance`` bits."""
    if not 0 <= distance < BYTES:
        raise ValueError("distance must leave a byte in common")
    spark, common = docs.sparkSession, BYTES - distance
    rows = written(fingerprints(docs, id_col, text_col, shingle), new_scratch(spark, "fingerprints"))
    by_fp = written(rows.groupBy("fp").agg(F.min("key").alias("first")), new_scratch(spark, "distinct"))
    found = written(_list_links(_postings(by_fp.select("fp"), common), common, distance, list_limit), new_scratch(spark, "lists"))
    links = found.where("b is not null")
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    if not crowded.isEmpty():
        links = links.union(ball_links(crowded, distance))
    linked = components(links)
    named = linked.join(by_fp, F.col("node") == F.col("fp")).select("node", "root", "first")
    ids = named.groupBy("root").agg(F.min("first").alias("group_id"))
    of_node = named.join(ids, "root").select(F.col("node").alias("fp"), "group_id")
    class_id = by_fp.join(of_node, "fp", "left").select("fp", F.coalesce("group_id", "first").alias("component_id"))
    # Written, so that the join below has an exchange on either side, and Spark can split the
    # rows of a fingerprint that very many documents have.
    class_id = written(class_id, new_scratch(spark, "classes"))
    out = rows.join(class_id, "fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select(F.col("key").alias(id_col), digits.alias("fingerprint"), "component_id")
