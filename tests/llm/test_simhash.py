"""SimHash fingerprints, links and components against plain loops."""

import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratemill.llm import simhash
from ratemill.llm.components import components


def fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(items, linked):
    root = {i: i for i in items}
    changed = True
    while changed:
        changed = False
        for a in items:
            for b in items:
                if linked(a, b) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_positions_hold_every_choice():
    from itertools import combinations

    for common in range(1, 8):
        sets = [set(s) for s in simhash.position_sets(common)]
        for own in combinations(range(8), common):
            assert any(s <= set(own) for s in sets)


TEXTS = ["", None, "one", "Two words", "a b c d e f", "A B\tC\nD E F", "a b c d e g", "ä\x1cb c d ü", "x " * 3000, "\x0b\x0c \r"]


@pytest.mark.parametrize("block", [simhash.TEXT_BLOCK, 40])
def test_fingerprints(spark, monkeypatch, block):
    import numpy as np
    import pyarrow as pa

    from ratemill.llm.segments import text_bytes

    monkeypatch.setattr(simhash, "TEXT_BLOCK", block)
    monkeypatch.setattr(simhash, "HASH_BLOCK", 5)
    got = simhash._fingerprints(*text_bytes(pa.array(TEXTS, pa.string())), 3)
    assert got.view(np.uint64).tolist() == [fingerprint(t) for t in TEXTS]


def family(seed, size):
    """Numbers in clusters, each a few bits from another."""
    r = random.Random(seed)
    out = [0]
    for _ in range(size):
        base = r.choice(out) if r.random() < 0.8 else r.getrandbits(64)
        for _ in range(r.randint(0, 4)):
            base ^= 1 << r.randrange(64)
        out.append(base)
    return sorted({signed(x) for x in out})


@pytest.mark.parametrize("limit", [1, 8, 16_384])
@pytest.mark.parametrize("distance", [1, 3])
def test_components_of_fingerprints(spark, limit, distance):
    fps = family(limit + distance, 160)
    rows = spark.createDataFrame([(x,) for x in fps], "fp long")
    common = 8 - distance
    found = simhash._list_links(simhash._postings(rows, common), common, distance, limit)
    links = found.where("b is not null")
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    if limit == 1:
        assert crowded.count() > 50
    links = links.union(simhash.ball_links(crowded, distance))
    got = {r.node: r.root for r in components(links).collect()}
    want = smallest_reachable(fps, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= distance)
    assert {x: got.get(x, x) for x in fps} == want


def test_many_alike_in_one_list(spark):
    # All within a bit or two of zero: one component, found inside tasks with few links.
    fps = sorted({signed(1 << i | 1 << j) for i in range(20) for j in range(20)} | {0})
    rows = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = simhash._list_links(simhash._postings(rows, 5), 5, 3, 16_384)
    assert links.count() <= 8 * len(fps)
    assert {r.root for r in components(links).collect()} == {0}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)), max_size=14))
def test_components(spark, pairs):
    links = spark.createDataFrame(pairs, "a long, b long")
    nodes = {x for p in pairs for x in p}
    both = {*pairs, *((b, a) for a, b in pairs)}
    assert {r.node: r.root for r in components(links).collect()} == smallest_reachable(nodes, lambda a, b: (a, b) in both)


def test_near_duplicates(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    long_text = [r.choice(words) for _ in range(600)]
    rows = []
    for i in range(40):
        copy = list(long_text)
        for _ in range(i % 4):
            copy[r.randrange(600)] = "changed"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, t) for i, t in enumerate(TEXTS)] + [(100, ""), (None, ""), (None, "only here and nowhere else"), (7, "a b c d e f")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fingerprint string, component_id int")
    got = simhash.near_duplicates(table, "doc_id", "text").collect()
    prints = [fingerprint(t) for _, t in rows]
    root = smallest_reachable(set(prints), lambda a, b: bin(a ^ b).count("1") <= 3)
    want = []
    for (i, _), p in zip(rows, prints):
        ids = [j for (j, _), q in zip(rows, prints) if root[q] == root[p] and j is not None]
        want.append((i, f"{p:016x}", min(ids, default=None)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(table.limit(0), "doc_id", "text").count() == 0


def test_few_links_take_no_exchange_per_round(spark, monkeypatch):
    import random

    from ratemill.llm import components as module

    plans = []
    monkeypatch.setattr(module, "written", lambda df, path, own=module.written: plans.append(df._jdf.queryExecution().executedPlan().toString()) or own(df, path))
    r = random.Random(5)
    links = {(r.randrange(400), r.randrange(400)) for _ in range(300)} | {(1000 + i, 1001 + i) for i in range(40)} | {(7, 7), (2000, 2000)}
    nodes = sorted({x for link in links for x in link})
    want = smallest_reachable(nodes, lambda a, b: (a, b) in links or (b, a) in links)
    table = spark.createDataFrame([*links, (None, 1)], "a long, b long").repartition(4)
    got = []
    for most in (module.TASK_LINKS, 0):
        monkeypatch.setattr(module, "TASK_LINKS", most)
        plans.clear()
        found = module.components(table)
        got.append([tuple(x) for x in found.collect()])
        assert len(plans) > 2 and any("hashpartitioning" in p for p in plans[1:]) == (most == 0)
    assert len(got[0]) == len(nodes) and sorted(got[0]) == sorted(got[1]) and dict(got[0]) == want
