"""A prefix trie of conversations, built and searched as a z-fast trie.

1. Turns are ordered by one range shuffle, and each gets its place in its conversation from the order of the partitions, so
   a conversation of any length is spread. The first turns are then replaced by those of the conversation's base.
2. Each place of each conversation gets a key of its prefix: 128 bits, sums of a SHA-256 of place, role and text. The sums
   run within blocks of ``BLOCK`` places first. Conversations with the same turns become one string, with a weight.
3. The trie is compacted: a node stands for an edge, from its parent's depth (exclusive) to its own, and ends where
   prefixes branch or a string ends. Its handle is the prefix at the two-fattest depth of the edge, the one that the
   largest power of two divides; nodes are found by the key of their handle.
4. Strings are inserted in batches that are drawn by hash and grow by a factor. For each string of a batch a fat binary
   search over its depths, one lookup of a handle at a time, finds the deepest node that is a prefix of it; the next turn
   tells the edge where it leaves the trie. Only what lies below, and the edges that are left inside, is grouped anew,
   which splits those edges and adds the new ones.
5. Sums over subtrees go up by pointer doubling over the nodes. At last every edge is expanded into its depths.

Groups are combined before they are shuffled, edges are expanded by equal joins on (string, depth), and the ids of equal
conversations are hashed as a stream of sorted runs, so no group comes together in memory.

Defined results: a null conv_id belongs to no conversation; a null role or text is empty; a null turn comes first; rows of
one turn are ordered by role, then text, and count as turns each, also if they are the same; an empty table gives an empty
result; other columns are ignored. Texts are hashed whole.
"""

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, site_count, staged

BLOCK = 4096
HEADS = 5  # a base gives this many turns at most
RUN_BYTES = 1 << 20


def zero() -> Column:
    """The key of the empty prefix."""
    return F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the largest power of two divides."""
    bits = (F.length(F.bin(low.bitwiseXOR(high))) - 1).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def placed(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and len of every turn."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")}
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", *text.values())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = rows.repartitionByRange(site_count(conversations.sparkSession), *order).sortWithinPartitions(*order)
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    at = F.monotonically_increasing_id()  # rises within a partition by one, and from each partition to the next
    turns = staged(ranged.select("conv_id", at.alias("at"), digest.alias("digest"), F.length("text").alias("len")), "turns")
    turns = turns.withColumn("part", F.shiftright("at", 33))
    runs = turns.groupBy("conv_id", "part").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", (F.col("start") - F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - 1).alias("start"))
    both = turns.join(runs, ["conv_id", "part"])
    return staged(both.select("conv_id", (F.col("at") - F.col("start")).alias("pos"), "digest", "len"), "placed")


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The turns with the first ``h`` taken from the base. ``convs``: conv_id, base, h, taken (how many the base gives)."""
    others = convs.where("conv_id != base")
    heads = turns.where(F.col("pos") <= HEADS).withColumnRenamed("conv_id", "base")
    given = others.join(heads, "base").where("pos <= h").select("conv_id", "pos", "digest", "len")
    own = turns.join(convs, "conv_id").where("conv_id = base OR pos > h")
    moved = F.when(F.col("conv_id") == F.col("base"), F.col("pos")).otherwise(F.col("pos") - F.col("h") + F.col("taken"))
    return own.select("conv_id", moved.alias("pos"), "digest", "len").unionByName(given)


def bases(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, base, h, taken and n (turns after the change) of each of ``convs`` (conv_id)."""
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    c = F.col("conv_id")
    told = convs.join(own, "conv_id", "left").select(
        "conv_id", F.coalesce("own", F.lit(0)).alias("own"), (c - c % 100).alias("base"), (F.crc32(c.cast("string")) % 6).alias("h")
    )
    there = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_n"))
    told = told.join(there, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    n = F.when(c == F.col("base"), F.col("own")).otherwise(F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    return told.select("conv_id", "base", "h", "taken", n.alias("n"))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, key, prev (the key one turn before), cum (code points so far) and len of each turn."""
    hexed = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.hex("digest")), 256)
    rows = turns.select("conv_id", F.col("pos").alias("depth"), "len", hexed.alias("x")).withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
    terms = [f"t{i}" for i in range(4)]
    rows = rows.withColumns({t: F.conv(F.substring("x", 1 + 8 * i, 8), 16, 10).cast("bigint") for i, t in enumerate(terms)}).drop("x")
    summed = [*terms, "len"]
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"sum_{c}": F.sum(c).over(so_far) for c in summed})
    blocks = rows.groupBy("conv_id", "block").agg(*(F.sum(c).alias(f"of_{c}") for c in summed))
    blocks = blocks.withColumn("block", F.col("block") + 1)  # what a block adds to the next ones
    running = Window.partitionBy("conv_id").orderBy("block")
    blocks = blocks.select("conv_id", "block", *(F.sum(f"of_{c}").over(running).alias(f"before_{c}") for c in summed))
    rows = rows.join(blocks, ["conv_id", "block"], "left")
    total = {c: F.col(f"sum_{c}") + F.coalesce(F.col(f"before_{c}"), F.lit(0)) for c in summed}

    def key(values: list[Column]) -> Column:
        low = [v.bitwiseAND(F.lit(0xFFFFFFFF)) for v in values]
        return F.struct(F.shiftleft(low[0], 32).bitwiseOR(low[1]).alias("a"), F.shiftleft(low[2], 32).bitwiseOR(low[3]).alias("b"))

    before = [total[t] - F.col(t) for t in terms]
    return rows.select("conv_id", "depth", key([total[t] for t in terms]).alias("key"), key(before).alias("prev"), total["len"].alias("cum"), F.col("len").cast("bigint").alias("len"))


def edge_rows(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The rows of ``paths`` on the edges of ``nodes`` (s, low, depth of the end), with the columns of their node."""
    start = F.explode(F.sequence(F.col("low") + 1, F.col("end"), F.lit(BLOCK).cast("bigint")))
    blocks = nodes.withColumn("start", start)
    depths = F.explode(F.sequence(F.col("start"), F.least(F.col("start") + (BLOCK - 1), F.col("end"))))
    return blocks.withColumn("depth", depths).drop("start").join(paths, ["s", "depth"])


def search(strings: DataFrame, paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """s and ``low``, the depth of the deepest node that is a prefix, of each string (s, n), by fat binary search."""
    handles = nodes.where("end > 0").select(
        F.col("fat"), F.col("handle"), F.col("low").alias("node_low"), F.col("end").alias("node_end"), F.col("key").alias("node_key")
    )
    at = paths.select("s", F.col("depth").alias("fat"), F.col("key").alias("handle"))
    whole = paths.select("s", F.col("depth").alias("node_end"), F.col("key").alias("node_key"), F.lit(True).alias("is_prefix"))
    zero_depth = F.lit(0).cast("bigint")
    state = staged(strings.select("s", zero_depth.alias("low"), F.col("n").cast("bigint").alias("high")), "search")
    while not (active := state.where("low < high")).isEmpty():
        probes = active.withColumn("fat", two_fattest(F.col("low"), F.col("high")))
        hits = probes.join(at, ["s", "fat"]).join(handles, ["fat", "handle"], "left")
        seen = hits.join(whole, ["s", "node_end", "node_key"], "left")
        missed, inside = F.col("node_end").isNull(), F.col("is_prefix").isNull()
        low = F.when(missed, F.col("low")).when(inside, F.col("node_low")).otherwise(F.col("node_end"))
        high = F.when(missed, F.col("fat") - 1).when(inside, F.col("node_low")).otherwise(F.col("high"))
        state = staged(seen.select("s", low.alias("low"), high.alias("high")).unionByName(state.where("low >= high")), "search")
    return state.select("s", "low")


def insert(nodes: DataFrame, strings: DataFrame, own: DataFrame, paths: DataFrame) -> DataFrame:
    """The nodes of the trie with the ``strings`` (s, n) added, whose rows of ``paths`` are ``own``."""
    exits = staged(search(strings, own, nodes).join(strings.select("s", "n"), "s").where("low < n"), "exits")
    below = own.join(exits, "s").where("depth > low").withColumn("is_end", F.col("depth") == F.col("n"))
    columns = ["s", "depth", "key", "prev", "cum", "low", "is_end"]
    names = below.where("depth = low + 1").select(F.col("key").alias("name"), "low").distinct()
    entered = nodes.join(names, ["name", "low"], "left_semi").select("s", "low", "end")
    left = edge_rows(entered, paths).withColumn("is_end", F.col("depth") == F.col("end"))
    rows = staged(below.select(columns).unionByName(left.select(columns)), "below")
    differ = F.greatest(*(F.max(f"key.{c}") != F.min(f"key.{c}") for c in "ab"))
    forks = rows.where("depth > low + 1").groupBy("prev").agg(differ.alias("fork")).where("fork").select(F.col("prev").alias("key"))
    ends = staged(forks.unionByName(rows.where("is_end").select("key")).distinct(), "ends")
    on_path = rows.join(ends, "key")
    above = F.lag("depth").over(Window.partitionBy("s").orderBy("depth"))
    on_path = on_path.withColumn("low", F.greatest("low", F.coalesce(above, F.col("low"))))
    found = on_path.groupBy("key").agg(*(F.min(c).alias(c) for c in ("s", "depth", "low", "cum"))).withColumnRenamed("depth", "end")
    found = found.withColumn("fat", two_fattest(F.col("low"), F.col("end")))
    first = paths.select(
        "s", (F.col("depth") - 1).alias("low"), F.col("key").alias("name"), F.col("prev").alias("parent"), (F.col("cum") - F.col("len")).alias("low_cum")
    )
    handle = paths.select("s", F.col("depth").alias("fat"), F.col("key").alias("handle"))
    new = found.join(first, ["s", "low"]).join(handle, ["s", "fat"]).select(nodes.columns)
    return staged(nodes.join(ends, "key", "left_anti").unionByName(new), "nodes")


def root(paths: DataFrame) -> DataFrame:
    number = {c: F.lit(v).cast("bigint") for c, v in (("end", 0), ("low", -1), ("fat", 0), ("cum", 0), ("low_cum", 0))}
    none = F.when(F.lit(False), zero())
    one = paths.sparkSession.range(1).select(
        zero().alias("key"), none.alias("parent"), none.alias("name"), none.alias("handle"), F.lit(None).cast("bigint").alias("s"), *(v.alias(c) for c, v in number.items())
    )
    return one


def build(strings: DataFrame, paths: DataFrame, first: int, growth: int) -> DataFrame:
    """The compacted trie: key, parent, name (key of the first place of the edge), handle, fat, s, low, end, cum, low_cum."""
    n = strings.count()
    batches = 1 + max(0, math.ceil(math.log(max(n, 1) / first, growth)))
    draw = F.pmod(F.xxhash64("s", F.lit("batch")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    batch = sum((F.when(draw >= float(growth) ** -k, 1).otherwise(0) for k in range(1, batches)), F.lit(0))
    strings, own = strings.withColumn("batch", batch), paths.withColumn("batch", batch)
    nodes = staged(root(paths), "nodes")
    for i in range(batches):
        nodes = insert(nodes, strings.where(F.col("batch") == i), own.where(F.col("batch") == i).drop("batch"), paths)
    return nodes


def subtree_sums(nodes: DataFrame, sums: list[str], least: str) -> DataFrame:
    """``nodes`` (key, parent, ...) with ``sums`` added up and the smallest ``least`` over each node's subtree.

    After k rounds a node holds what lies fewer than 2 ** k levels below it, and points that far up.
    """
    up = staged(nodes.select("key", F.col("parent").alias("jump"), *sums, least), "subtrees")
    while not (moving := up.where("jump IS NOT NULL")).isEmpty():
        gain = moving.groupBy(F.col("jump").alias("key")).agg(*(F.sum(c).alias(f"more_{c}") for c in sums), F.min(least).alias("other"))
        next_up = up.select(F.col("key").alias("jump"), F.col("jump").alias("further"))
        added = [(F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in sums]
        far = up.join(gain, "key", "left").select("key", "jump", *added, F.least(least, "other").alias(least))
        up = staged(far.join(next_up, "jump", "left").select("key", F.col("further").alias("jump"), *sums, least), "subtrees")
    return up.drop("jump")


def ends_digests(ends: DataFrame) -> DataFrame:
    """key and the SHA-256 of the comma-joined, ascending ids of each key's rows (key, conv_id).

    Sorted runs of ids become rows of up to ``RUN_BYTES``, and these are hashed in order, one at a time.
    """
    flat = ends.select("key.a", "key.b", "conv_id")
    ship(ends.sparkSession)
    runs_schema, digest_schema = "a bigint, b bigint, first bigint, ids binary", "a bigint, b bigint, ends_sha256 string"

    def batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        types = {"ids": pa.binary(), "ends_sha256": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(c, types.get(x, pa.int64())) for c, x in zip(zip(*rows, strict=True), names, strict=True)], names)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size = None, [], 0

        def done() -> tuple:
            return (*key, ids[0], ",".join(map(str, ids)).encode())

        out = []
        for part in batches:
            for a, b, i in zip(*(part[c].to_pylist() for c in ("a", "b", "conv_id")), strict=True):
                if (a, b) != key or size > RUN_BYTES:
                    if key:
                        out.append(done())
                    key, ids, size = (a, b), [], 0
                ids.append(i)
                size += 20
            if out:
                yield batch(out, ["a", "b", "first", "ids"])
                out = []
        if key:
            yield batch([done()], ["a", "b", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for part in batches:
            out = []
            for a, b, ids in zip(part["a"].to_pylist(), part["b"].to_pylist(), part["ids"], strict=True):
                if (a, b) == key:
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256()
                state.update(ids.as_buffer())
            if out:
                yield batch(out, ["a", "b", "ends_sha256"])
        if key:
            yield batch([(*key, state.hexdigest())], ["a", "b", "ends_sha256"])

    parts, order = site_count(ends.sparkSession), ["a", "b", "conv_id"]
    sorted_runs = flat.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(runs, runs_schema)
    hashed = sorted_runs.repartition(parts, "a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(digests, digest_schema)
    return hashed.select(F.struct("a", "b").alias("key"), "ends_sha256")


def conversation_trie(conversations: DataFrame, first: int = 64, growth: int = 32) -> DataFrame:
    """For each node of the expanded trie: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. The batches hold about ``first`` strings and ``growth`` times more each."""
    turns = placed(conversations)
    convs = staged(bases(turns, turns.select("conv_id").distinct()), "convs")
    rows = staged(prefixes(rebuilt(turns, convs)), "prefixes")
    full = rows.select("conv_id", F.col("depth").alias("n"), "key", "cum")
    ends = convs.select("conv_id", "n").join(full, ["conv_id", "n"], "left")
    ends = staged(ends.select("conv_id", "n", F.coalesce("key", zero()).alias("key"), F.coalesce("cum", F.lit(0)).alias("cum")), "strings")
    strings = ends.groupBy("key").agg(F.min("conv_id").alias("s"), F.count(F.lit(1)).alias("weight"), F.min("n").alias("n"), F.min("cum").alias("cum"))
    strings = staged(strings, "strings")
    paths = staged(rows.withColumnRenamed("conv_id", "s").join(strings.select("s"), "s", "left_semi"), "paths")
    nodes = build(strings, paths, first, growth)

    weights = strings.select("key", F.col("s").alias("first"), "weight", (F.col("weight") * F.col("cum")).alias("spent"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    told = nodes.join(weights, "key", "left").join(children, "key", "left").select(
        *(nodes[c] for c in nodes.columns if c != "s"),
        "first",
        F.coalesce("weight", F.lit(0)).alias("n_convs"),
        F.coalesce("spent", F.lit(0)).alias("spent"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
        (F.col("cum") - F.col("low_cum")).alias("held"),
    )
    told = staged(told, "told")
    sums = ["n_convs", "spent", "n_leaves", "held"]
    whole = staged(subtree_sums(told, sums, "first"), "whole")
    parents = whole.select(F.col("key").alias("parent"), F.col("first").alias("parent_first"))
    nodes = whole.join(told.select("key", "parent", "low", "end", "low_cum", "n_children"), "key").join(parents, "parent", "left")
    nodes = nodes.join(ends_digests(ends.select("key", "conv_id")), "key", "left").withColumnRenamed("first", "s").drop("key", "parent")

    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    top = nodes.where("end = 0 AND n_convs > 0").select(F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("before"), *nodes.columns)
    inner = edge_rows(nodes.where("end > 0"), paths.select("s", "depth", (F.col("cum") - F.col("len")).alias("before")))
    expanded = top.unionByName(inner)
    is_end = F.col("depth") == F.col("end")
    spent = F.col("spent") - F.col("n_convs") * F.col("before")
    held = F.col("held") - (F.col("before") - F.col("low_cum"))
    parent = F.when(F.col("depth") == F.col("low") + 1, F.col("parent_first")).otherwise(F.col("s"))
    return expanded.select(
        F.col("s").alias("conv_id"),
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        F.when(is_end, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"),
        "n_leaves",
        (spent - held).alias("saved_tokens"),
        F.when(is_end, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )
