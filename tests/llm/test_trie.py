"""The conversation trie against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillroll.llm import trie

from .conftest import with_clashes

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_hand(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in turns.items()}
    told = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        told[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(int)
    for c, v in told.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += not children[node]
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(told[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **how):
    df = with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    return sorted(map(tuple, trie.conversation_trie(df, **how).collect()), key=str)


def chats(seed, n, letters, longest, ids=None):
    rng, rows = random.Random(seed), []
    for c in ids or range(n):
        rows += [(c, t, rng.choice("ua"), rng.choice(letters) * rng.choice((1, 2))) for t in range(rng.randrange(1, longest))]
    return rows


@pytest.mark.parametrize(("first", "growth"), [(64, 32), (2, 2)])
def test_trie_by_hand(spark, first, growth):
    rows = chats(1, 230, "xy", 9)
    rows += [(c, t, "u", f"turn {t}") for c in range(300, 340) for t in range(7)]  # the same conversation, often
    rows += [(c, t, "u", "ab"[c % 2]) for c in range(400, 420) for t in range(c - 398)]  # each a prefix of the next
    assert run(spark, rows, first=first, growth=growth) == by_hand(rows)


def test_long_conversations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    rows = chats(2, 0, "xyz", 40, ids=[3, 100, 107, 200, 201, 900])
    rows += [(i, t, "u", "same" if t < 250 - i else f"{i}") for i in (1000, 1100, 1200) for t in range(300)]
    assert run(spark, rows, first=2, growth=2) == by_hand(rows)


def test_edges(spark):
    rows = [
        (None, 0, "u", "no conversation"),
        (0, None, None, None),
        (0, None, "u", "first"),
        (0, 5, "", ""),
        (0, 5, "", ""),
        (0, 2, "u", "y" * 100_000),
        (1, 0, "u", "a"),  # alone and short: its base gives all it has
        (105, 0, "u", "b"),  # no base: may be left without turns
        (109, 0, "u", "b"),
        (-5, 0, "u", "c"),
        (-250, 3, "u", "\U0001f600\x00é"),
        (2**62, 1, "u", "far"),
    ]
    assert run(spark, rows) == by_hand(rows)
    rows = [(c, 0, "u", "b") for c in range(101, 160)]
    assert run(spark, rows) == by_hand(rows)
    assert any(r[0] is not None and r[1] == 0 for r in run(spark, rows))


def test_nothing_in_nothing_out(spark):
    out = trie.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert run(spark, [(None, 1, "u", "x")]) == []


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(-1, 70) for b in range(max(a, 0) + 1, 75)] + [(0, 2**40 - 1), (2**40, 2**40 + 1)]
    got = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", trie.two_fattest(F.col("a"), F.col("b")))
    for a, b, f in got.where("a >= 0").collect():
        assert a < f <= b
        if b < 100:
            assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_digests_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN_BYTES", 200)
    ends = [(i % 3 * (i % 7 == 0), i, i * 37 % 1000 - 300) for i in range(1000)]
    ends = spark.createDataFrame(ends, "k bigint, i bigint, conv_id bigint")
    df = ends.select(F.struct(F.col("k").alias("a"), F.lit(1).cast("bigint").alias("b")).alias("key"), "conv_id").repartition(9)
    got = {r["key"]["a"]: r["ends_sha256"] for r in trie.ends_digests(df).collect()}
    want = defaultdict(list)
    for r in ends.collect():
        want[r["k"]].append(r["conv_id"])
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}


def test_the_search_ends_at_the_deepest_node(spark):
    """Every string of a second batch, against the nodes of the first, found by trying each prefix."""
    turns = spark.createDataFrame(chats(4, 150, "xy", 30), SCHEMA)
    rows = trie.prefixes(trie.placed(turns)).withColumnRenamed("conv_id", "s").cache()
    strings = rows.groupBy("s").agg(F.max("depth").alias("n"))
    old, new = "s % 3 = 0", "s % 3 <> 0"
    nodes = trie.insert(trie.root(rows), strings.where(old), rows.where(old), rows)
    ends = {tuple(r["key"]) for r in nodes.collect()}
    keys = defaultdict(dict)
    for r in rows.where(new).collect():
        keys[r["s"]][r["depth"]] = tuple(r["key"])
    want = {s: max([0, *(d for d, k in path.items() if k in ends)]) for s, path in keys.items()}
    assert {r["s"]: r["low"] for r in trie.search(strings.where(new), rows.where(new), nodes).collect()} == want
