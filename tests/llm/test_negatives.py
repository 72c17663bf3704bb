"""Hard negatives against all pairs, and the parts of the index."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratemill.llm import negatives
from ratemill.llm.negatives import Rule
from ratemill.llm.queries import op13_hard_negatives

SF = "/root/testdata/sf0.01"
LONG = 2**63


def plain(rows, is_anchor, rule=Rule()):
    """The negatives by looking at all rows of every anchor; ``rows`` are (id, label, vector)."""
    good = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, label, [max(-LONG, min(LONG - 1, math.floor(256 * x))) if math.isfinite(256 * x) else (LONG - 1 if x > 0 else -LONG) for x in v]))
    out = []
    for place, (i, label, v) in enumerate(good):
        if not is_anchor(i):
            continue
        ranked = sorted((-max(-LONG, min(LONG - 1, sum(a * b for a, b in zip(v, w)))), j, k != label, n) for n, (j, k, w) in enumerate(good))
        positives = [r for r in ranked if not r[2] and r[3] != place][: rule.positives]
        for p in positives:
            fits = [r for r in ranked if r[2] and -rule.low * p[0] <= -100 * r[0] <= -rule.high * p[0]]
            out += [(i, p[1], rank, r[1], -p[0], -r[0]) for rank, r in enumerate(fits[: rule.negatives], 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(table, every, **options):
    df = negatives.mine(table, "vec_id", F.col("label"), "embedding", F.col("vec_id") % every == 0, **options)
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    moved = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in rows]
    got = sorted(map(tuple, op13_hard_negatives(spark, SF).select(COLUMNS).collect()))
    assert got and got == plain(moved, lambda i: i % 100 == 0)


def clusters(n, dim, spread, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, i % 3, [float(x) for x in np.round(centres[i % 12] + rng.normal(size=dim) * spread, 2)]) for i in range(n)]


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("spread", [0.0, 0.05, 0.5])
def test_clusters(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "FIRST_ROWS", 40)
    rows = clusters(600, 6, spread)
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(5), 20, pass_anchors=7)
    assert got == plain(rows, lambda i: i % 20 == 0)


def test_cells_are_left_out():
    """On clustered vectors the certified cells are few, and no needed one is left out."""
    rows = clusters(3000, 8, 0.02)
    q = np.floor(256 * np.array([r[2] for r in rows])).astype(np.int64)
    index = negatives.Index((negatives.codebook(q[:, :4].astype(float), 12), negatives.codebook(q[:, 4:].astype(float), 12)), 8)
    cell, far = index.assign(q)
    index.rows = np.bincount(cell, minlength=len(index.books[0]) * len(index.books[1]))
    n2 = len(index.books[1])
    index.radii = tuple(np.array([f[c == k].max(initial=0) for k in range(len(b))]) for f, c, b in zip(far, (cell // n2, cell % n2), index.books))
    scores = q[:50] @ q.T
    floors = np.sort(scores, axis=1)[:, -6]
    need = index.needed(q[:50], floors)
    for k in range(50):
        assert need[k, np.unique(cell[scores[k] >= floors[k]])].all()
    assert need.sum() < 0.3 * 50 * (index.rows > 0).sum()
    left, right = index.bounds(q[:1])
    order = list(index.visit(left[0], right[0]))
    assert [b for b, _ in order] == sorted((b for b, _ in order), reverse=True)
    assert sorted(c for _, c in order) == np.flatnonzero(index.rows).tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0, 3.0]), (0, 1, [1.0, 2.0, 3.0]), (0, 2, [1.0, 2.0, 2.5]), (1, 1, [1.0, 2.0, 3.0]), (2, 2, [1.0, 2.0, 2.9]), (3, 2, [1.0, 2.0, 2.9]),
        (4, 1, [1.0]), (5, 2, []), (6, None, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (7, 1, None), (8, 1, [nan, 1.0, 1.0]),
        (9, 2, [inf, 1.0, 1.0]), (10, 1, [None, 1.0, 1.0]), (20, 1, [-1.0, -1.0, 0.0]), (30, 1, [0.0, 0.0, 0.0]), (11, 2, [0.0, 0.0, 0.0]),
        *((40 + i, i % 2 + 1, [0.5, 0.5, 0.5]) for i in range(12)),
    ]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS q", "3 AS cell", "4 AS n", "true AS is_anchor")
    assert mined(table, 10) == plain(rows, lambda i: i % 10 == 0)


def test_scores_beyond_doubles(spark):
    rows = [(i, i % 2, [1e15 + i * 3.0, 1e14 + i]) for i in range(20)] + [(20, 0, [1e300, -1e300]), (21, 1, [1e300, 2.0])]
    assert mined(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows, lambda i: i % 10 == 0)
    rows = [(i, i % 2, [1e6 + i * 3.0, 1e6 - i]) for i in range(40)]
    assert mined(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows, lambda i: i % 10 == 0)


def test_very_long_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, [float(x) for x in rng.normal(size=3000)]) for i in range(30)]
    assert mined(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows, lambda i: i % 10 == 0)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark.createDataFrame([], SCHEMA), 10) == []
    assert mined(spark.createDataFrame([(1, 1, [1.0])], SCHEMA), 10) == []
    assert mined(spark.createDataFrame([(10, None, [1.0])], SCHEMA), 10) == []
