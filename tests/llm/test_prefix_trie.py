"""The prefix trie against a plain tree of dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from ratemill.llm import prefix_trie
from ratemill.llm.queries import op12_prefix_trie

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rows):
    """Turns by conversation in order; turns of one number by the digest of role and text."""

    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]

    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    return {c: [x[3] for x in sorted(v)] for c, v in out.items()}


def spliced(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        giver = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(giver, [])[:h] + turns[h:]
    return out


def plain(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, who in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * words
    out = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(who), len(node), parent, len(who), children.get(node, 0), leaves[node], saved[node], sha))
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def built(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=lambda r: (r[0], r[1], r[3]))


def trie_of(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    turns, convs = prefix_trie.read_turns(table, "conv_id", "turn", "role", "text")
    return built(prefix_trie.trie(turns, convs, **options))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op12_prefix_trie(spark, SF)
    assert built(got) == plain(spliced(conversations(rows)))


@pytest.mark.parametrize("slab, block", [(2, 3), (1, 2), (3, 1), (5, 64), (64, 7), (64, 4096)])
def test_random_conversations(spark, slab, block):
    rng = random.Random(slab * 100 + block)
    rows = []
    for c in range(70):
        n = rng.choice([1, 2, 3, 4, 7, 11])
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "a b", "a b c d"]) if t < 2 or rng.random() < 0.3 else "same old words"))
    rows += [(100 + c, t, "user", "copy of one") for c in range(25) for t in range(9)]
    rows += [(200 + c, t, "user", "copy of one") for c in range(6) for t in range(9 + c)]
    assert trie_of(spark, rows, slab=slab, block=block) == plain(conversations(rows))


def test_copies_across_blocks(spark):
    rows = [(c, t, "user", f"turn {t} of all") for c in range(60) for t in range(6)]
    for slab, block in [(2, 4), (6, 8), (64, 16)]:
        assert trie_of(spark, rows, slab=slab, block=block) == plain(conversations(rows))


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "x"), (1, None, "user", "first"), (1, 1, None, None), (1, 1, "", ""), (1, 2, "user", None), (2, 0, "us", "era"), (3, 0, "user", "a"),
        (4, 0, "user", "w " * 300_000), (5, 0, "user", "w " * 300_000), (-7, 0, "user", "same"), (6, 0, "user", "same"), *[(9, 3, "user", "again")] * 40,
        *((10, t, "user", "again") for t in range(300)),
    ]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS at", "3 AS digest", "4 AS words", "5 AS g")
    turns, convs = prefix_trie.read_turns(table, "conv_id", "turn", "role", "text")
    own = conversations(rows)
    assert built(prefix_trie.trie(turns, convs, slab=16, block=5)) == plain(own)
    assert built(prefix_trie.trie(*prefix_trie.splice(turns, convs, 20, 4), slab=16, block=5)) == plain(spliced(own))


def test_only_turnless(spark):
    """Conversations that end before their head is over, without a giver."""
    short = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0]
    rows = [(c, 0, "user", "gone") for c in short]
    turns, convs = prefix_trie.read_turns(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    got = built(prefix_trie.trie(*prefix_trie.splice(turns, convs, 20, 4), block=4))
    assert got == plain(spliced(conversations(rows))) and [r[1] for r in got] == [0] and got[0][5] == 1


def test_empty_table(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 0, "user", "x")]) == []
