"""The set-based merge against a merge of one row at a time."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ratemill.operators import ids, merge
from ratemill.operators.ids import add_surrogate_key, assign_ids
from ratemill.operators.merge import MergeRule, changed_rows, count_actions, merge_actions, upsert
from ratemill.operators.ranges import in_ranges, key_ranges
from ratemill.session import written

SCHEMA = "k int, g string, a string, b int"


def row_by_row(target, batch, rule):
    """Merge ``batch`` into ``target`` (lists of dicts); returns table and actions."""
    table = [dict(r) for r in target]
    next_id = max([r["ID"] for r in table], default=0) + 1
    actions = []
    for row in batch:
        hits = [r for r in table if all(r[k] == row[k] for k in rule.key)]
        if not hits:
            table.append({c: row[c] for c in rule.columns} | {"ID": next_id})
            next_id += 1
            actions.append("INSERT")
            continue
        differs = any(r[c] != row[c] for r in hits for c in rule.updated)
        for r in hits:
            r.update({c: row[c] for c in rule.updated})
        actions.append("UPDATE" if differs or rule.update_when == "always" else "UNCHANGED")
    return table, actions


def random_case(seed):
    rng = random.Random(seed)
    keys, n = rng.choice([3, 8, 40]), rng.choice([0, 5, 60])

    def row():
        return {
            "k": rng.randrange(keys),
            "g": rng.choice("xy"),
            "a": rng.choice(["p", "q", None]),
            "b": rng.choice([1, 2, None]),
        }

    target = [row() | {"ID": i + 1} for i in range(rng.choice([0, 4, 30]))]
    batch = [row() | {"n": i * 3} for i in range(n)]
    if seed % 2:  # a hot key
        for r in batch[:: 2]:
            r["k"], r["g"] = 0, "x"
    return target, batch


RULES = {
    "always": MergeRule(("k", "g"), ("k", "g", "a", "b")),
    "insert_only": MergeRule(("k", "g"), ("k", "g", "a", "b"), insert_only=("a",)),
    "changed": MergeRule(("k", "g"), ("k", "g", "a", "b"), update_when="changed"),
}


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("kind", RULES)
def test_equals_row_by_row(spark, kind, seed):
    rule = RULES[kind]
    target, batch = random_case(seed)
    table, actions = row_by_row(target, batch, rule)
    t = spark.createDataFrame([tuple(r.values()) for r in target], SCHEMA + ", ID long")
    b = spark.createDataFrame([tuple(r.values()) for r in batch], SCHEMA + ", n long").repartition(3)

    got = upsert(t, b, rule, ["n"])
    assert sorted(map(str, (r.asDict() for r in got.collect()))) == sorted(map(str, table))

    # Plain windows, then every key with over 4 rows cut into chunks.
    for hot_rows in (1_000_000, 4):
        out = merge_actions(t, b, rule, ["n"], hot_rows=hot_rows, chunk_parts=6)
        assert [r._action for r in out.orderBy("n").collect()] == actions


ORDERS = {
    "fraction": (lambda i: (i / 7, i), "p double, id long"),
    "time": (lambda i: (dt.datetime(2026, 1, 1) + dt.timedelta(milliseconds=250 * i), i), "p timestamp, id long"),
    "text": (lambda i: (f"{i:05d}", i), "p string, id long"),
    "coarse": (lambda i: (i // 5 / 2, i), "p double, id long"),
}


@pytest.mark.parametrize("kind", ORDERS)
@pytest.mark.parametrize("columns", [["p"], ["p", "id"]])
def test_one_answer_on_both_sides_of_the_hot_size(spark, kind, columns):
    if kind == "coarse" and columns == ["p"]:
        return  # not an order of its own
    make, schema = ORDERS[kind]
    rng = random.Random(5)
    batch = [{"k": rng.choice([1, 1, 1, 2, 3]), "g": "x", "a": rng.choice("pq"), "b": 1} for _ in range(120)]
    rule = RULES["changed"]
    _, actions = row_by_row([{"k": 1, "g": "x", "a": "p", "b": 1, "ID": 1}], batch, rule)
    rows = [(*r.values(), *make(i)) for i, r in enumerate(batch)]
    b = spark.createDataFrame(rows, f"{SCHEMA}, {schema}").repartition(3)
    t = spark.createDataFrame([(1, "x", "p", 1)], SCHEMA)
    for hot_rows in (1_000_000, 10):
        out = merge_actions(t, b, rule, columns, hot_rows=hot_rows, chunk_parts=9)
        assert [r._action for r in out.orderBy("id").collect()] == actions


def test_a_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    rule = MergeRule(("k",), ("k", "a"))
    spark.range(5000).selectExpr("id AS k", "'old' AS a", "id + 1 AS ID").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(7, "new", 1), (9000, "new", 2)], "k long, a string, n int")
    collapsed = written(merge.collapse_batch(batch, rule, ["n"]), str(tmp_path / "b"))
    plan = merge.update_matched(table, collapsed, rule)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("LeftOuter") == 1 and plan.count("FileScan") == 2
    got = upsert(table, batch, rule, ["n"])
    # The table was read by the one join; matches, ids and the result come from what that wrote.
    assert str(tmp_path / "t") not in got._jdf.queryExecution().toString()
    assert got.where("a = 'new'").orderBy("k").collect() == [(7, "new", 8), (9000, "new", 5001)]


def test_key_ranges(spark):
    def ranges(values, most=32):
        return key_ranges(spark.createDataFrame([(v,) for v in values], "k long"), "k", most)

    assert ranges([]) == [] and ranges([None]) == [] and ranges([5, 5]) == [(5, 5)]
    assert ranges([1, 10**9]) == [(1, 1), (10**9, 10**9)]
    assert ranges([1, 2, 3, 10**9, 10**9 + 1, None]) == [(1, 3), (10**9, 10**9 + 1)]
    assert ranges(range(1000)) == [(0, 999)]
    assert ranges([-(2**62), 0, 2**62]) == [(-(2**62), -(2**62)), (0, 0), (2**62, 2**62)]
    rng = random.Random(1)
    values = [rng.randrange(10**6) * rng.choice([1, 1000, 10**6]) for _ in range(500)]
    found = ranges(values, 8)
    assert len(found) == 8 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    assert all(any(low <= v <= high for low, high in found) for v in values)


def test_ranges_skip_row_groups(spark, tmp_path):
    """Two keys far apart: only their row groups are read."""
    table = pa.table({"k": pa.array([i * 1000 for i in range(100_000)], pa.int64())})
    pq.write_table(table, tmp_path / "t.parquet", row_group_size=10_000)
    keys = spark.createDataFrame([(0,), (99_999_000,)], "k long")
    found = spark.read.parquet(str(tmp_path / "t.parquet")).where(in_ranges("k", key_ranges(keys, "k")))
    assert found.count() == 2 and "PushedFilters: [Or(" in found._jdf.queryExecution().toString()
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan()
    rows = found.collect()
    scan = plan.collectLeaves().head()
    assert len(rows) == 2 and scan.metrics().apply("numOutputRows").value() <= 2 * 20_000


def test_only_rows_of_the_batchs_keys_are_reduced(spark, tmp_path):
    spark.range(5000).selectExpr("id AS k", "'old' AS a").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(7, "new"), (8, "old"), (9000, "new")], "k long, a string")
    found = changed_rows(batch, table, ["k"], ["a"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("partial_min")  # below the aggregate
    assert found.collect() == [(7, "new")]


def test_hot_key_over_many_chunks_with_tuple_order(spark):
    """Most rows have one key; the order is (block, id), the chunk its block."""
    rng = random.Random(3)
    batch = [
        {"k": 1 if rng.random() < 0.7 else rng.randrange(50), "g": "x", "a": rng.choice("pq"), "b": 1}
        for _ in range(2000)
    ]
    rule = RULES["changed"]
    target = [{"k": 1, "g": "x", "a": "p", "b": 1, "ID": 1}]
    _, actions = row_by_row(target, batch, rule)
    rows = [(*r.values(), i // 90, i) for i, r in enumerate(batch)]
    b = spark.createDataFrame(rows, SCHEMA + ", block long, id long").repartition(5)
    t = spark.createDataFrame([(1, "x", "p", 1)], SCHEMA)
    out = merge_actions(t, b, rule, ["block", "id"], hot_rows=100)
    assert [r._action for r in out.orderBy("id").collect()] == actions
    counts = count_actions(out, ["g"]).first()
    assert counts.processed == sum(a != "UNCHANGED" for a in actions)
    assert counts.row_count == 2000


def test_integer_and_collated_keys(spark):
    rule = MergeRule(("i", "code"), ("i", "code", "v"), integer_keys=("code",))
    t = spark.createDataFrame([(1, "350", "old", 1), (1, "x", "odd", 2)], "i int, code string, v string, ID long")
    b = spark.createDataFrame([(1, "0350", "new", 1), (2, "7", "z", 2)], "i int, code string, v string, n int")
    got = {tuple(r) for r in upsert(t, b, rule, ["n"]).collect()}
    assert got == {(1, "350", "new", 1), (1, "x", "odd", 2), (2, "7", "z", 3)}

    rule = MergeRule(
        ("code",), ("code", "v"), key_collation="UTF8_LCASE_RTRIM", text_keys=("code",)
    )
    t = spark.createDataFrame([("Abc", "old", 1)], "code string, v string, ID long")
    b = spark.createDataFrame(
        [("aBC ", "new", 1), ("Q", "first", 2), ("q", "last", 3)], "code string, v string, n int"
    )
    got = {tuple(r) for r in upsert(t, b, rule, ["n"]).collect()}
    assert got == {("Abc", "new", 1), ("Q", "last", 2)}


def test_assign_ids_follows_order(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(7)
    got = assign_ids(df, ["v"], start=10).collect()
    assert sorted((r.v, r.ID) for r in got) == [(i, i + 11) for i in range(1000)]


def test_surrogate_key(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (2, "a")], "RATE_ID int, x string")
    got = {tuple(r) for r in add_surrogate_key(df, ["RATE_ID"]).collect()}
    assert got == {(1, "z", 1), (2, "a", 2), (2, "b", 3)}


@pytest.mark.parametrize("most", [0, 1_000])
def test_collapse_passes_single_rows_through_beyond_the_rows_that_are_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(merge, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(merge, "BROADCAST_HASHES", most)
    rule = MergeRule(("k",), ("k", "v"), integer_keys=("k",))
    rows = [(str(k) if i else f"0{k}", f"{k}-{i}", 10 * k + i) for k in range(40) for i in range(1 + (k % 8 == 0))]
    batch = spark.createDataFrame(rows, "k string, v string, n int")
    repeated = merge.repeated_keys(batch, rule)
    assert repeated.count() == 5
    out = merge.collapse_around(batch, rule, ["n"], repeated, 5)
    assert ("Union" in out._jdf.queryExecution().optimizedPlan().toString()) == bool(most)
    want = {(f"0{k}", f"{k}-{int(k % 8 == 0)}", 10 * k, 1 + (k % 8 == 0)) for k in range(40)}
    assert {tuple(r) for r in out.select("k", "v", "_first", "_n").collect()} == want


def test_parted_by_hash_keeps_every_row(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (2, "d"), (None, "e")], "k int, v string")
    keys = merge.hashes(rows.where("k = 2 OR k IS NULL"), ["k"])
    inside, outside = merge.parted(rows, ["k"], keys)
    assert {r.v for r in inside.collect()} == {"c", "d"}
    assert {r.v for r in outside.collect()} == {"a", "b", "e"}


def test_many_hashes_are_told_apart_by_bits(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(merge, "BROADCAST_ROWS", 1)
    rows = spark.range(20_000).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    keys = merge.hashes(rows.where("v % 5 = 0"), ["k"])
    marked = merge.marks(keys, keys.count(), str(tmp_path / "marks"))
    assert "_words" in marked.columns
    inside, outside = ({r.v for r in x.collect()} for x in merge.parted(rows, ["k"], marked))
    wanted = {v for v in range(0, 20_000, 5) if v % 7}
    assert wanted <= inside and len(inside) < 1.5 * len(wanted)
    assert inside | outside == set(range(20_000)) and not inside & outside
    plan = merge.parted(rows, ["k"], marked)[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("most", [50, 1_000])
def test_rows_are_dealt_by_a_known_number_without_a_sample(spark, monkeypatch, tmp_path, most):
    monkeypatch.setattr(ids, "PART_ROWS", most)
    df = spark.range(0, 2_000, 2).select((1999 - F.col("id")).alias("n"), F.col("id").alias("v")).repartition(3)
    placed = ids.dealt_rows(df, F.col("n"), 2_000, str(tmp_path / "placed"))
    got = sorted((r.ID, r.v) for r in ids.number_placed(placed, 10, "ID").collect())
    assert got == [(i + 11, 1998 - 2 * i) for i in range(1_000)]
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert max(sizes) <= most
