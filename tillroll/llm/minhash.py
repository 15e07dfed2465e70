"""Near-duplicate groups by b-bit MinHash.

1. Every document becomes its set of distinct word shingles (64-bit hashes), ``bands * rows`` minima over it, a key for
   each band of ``rows`` minima, and a signature of the low ``bits`` bits of all minima, packed into longs.
2. Documents with the same set are one class, with a number of its own; a row with its smallest id stands for it.
3. Classes that share a band key are candidates. In every bucket a leader is compared with each member, never all with
   all. The packed signatures estimate the similarity by bit counts, corrected for the 2 ** -bits chance that unequal
   minima agree; pairs five standard errors under the threshold go.
4. Each member is confirmed against its most similar leader on the full sets, then against those of its other leaders
   that are in another component by then; confirmed links give first components.
5. Buckets that still hold several components: their pairs across components are estimated inside the join, by finer
   signatures of one bit per minimum, and those that may be links are confirmed as well, each pair once. Members of one
   component need no further links, so a bucket of copies costs as many pairs as it has members.
6. Components of all confirmed links; every document gets its smallest id.

A pair right at a similarity of 0.8 shares no band with probability (1 - 0.8 ** rows) ** bands, 5e-6 by default.

Defined results: a null or blank text has an empty set and stands alone; a text with fewer words than a shingle is one
shingle; rows that repeat an id are documents each, so those with different texts may have different groups; rows without
id take no part in links and are kept; an empty table gives an empty result; other columns are ignored. Texts are read
whole, in pieces of bounded size.
"""

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascend, descend, map_rows, match_rows, only_ids, row_keys, site_count, site_of, staged
from .components import components

WHITE = re.compile(rb"[\x20\x09-\x0D]")
PIECE = 1 << 20
GIANT = 64
FEATURES = "doc_id bigint, row_1 bigint, row_2 bigint, n_shingles bigint, digest binary, signature array<bigint>, bands array<bigint>"


SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: The low 0 to 8 bytes of a long.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _piece_words(raw: bytes) -> np.ndarray:
    """Eight bytes at a time, each step a bijection of those bytes, mixed before the next: no two words of up to eight
    bytes and one length collide, and longer ones only by chance."""
    blank = SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    eights = np.ndarray(len(raw) + 1, "<u8", raw + bytes(8), strides=(1,))  # the eight bytes from each place on
    out = mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    at, left, which = starts, size, np.arange(len(starts))
    while len(which):
        part = eights[at] & LOW_BYTES[np.minimum(left, 8)]
        out[which] = mix(out[which] * np.uint64(0xD6E8FEB86659FD93) + part)
        more = (left > 8) & (size[which] <= GIANT)
        at, left, which = at[more] + 8, left[more] - 8, which[more]
    for i in np.flatnonzero(size > GIANT):
        out[i] = _giant(raw[starts[i] : ends[i]])
    return out


def _giant(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, A-Z in lower case. Long texts are cut into pieces between words."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    out, at = [], 0
    while at < len(raw):
        end = at + PIECE
        if end < len(raw):
            cut = WHITE.search(raw, end)
            end = cut.start() if cut else len(raw)
            if end - at > 2 * PIECE:  # a word of over a piece ends here: it gets a piece of its own
                before = max(raw.rfind(c, at, at + PIECE) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
                if before <= at:
                    word = raw[at:end].strip(b" \t\n\x0b\x0c\r")
                    out.append(np.array([_giant(word)] if word else [], np.uint64))
                    at = end
                    continue
                end = before
        out.append(_piece_words(raw[at:end]))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of the whole text if it has fewer words."""
    words = word_hashes(text)
    if not len(words):
        return words
    k = min(width, len(words))
    h = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[j : len(words) - k + 1 + j])
    return np.unique(h)


@cache
def _family(n: int) -> np.ndarray:
    """Odd multipliers: each makes a permutation of the 32-bit numbers."""
    return np.random.default_rng(7).integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(shingles: np.ndarray, n: int) -> np.ndarray:
    """The smallest value of the set under each of ``n`` hash functions."""
    a, low = _family(n), np.full(n, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(low, (x[i : i + 256, None] * a).min(axis=0), out=low)
    return low


def packed(low: np.ndarray, bits: int) -> np.ndarray:
    """The ``bits`` low bits of each minimum, side by side in longs; a row for each set."""
    small = ((low * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.uint8)
    flat = np.unpackbits(small[:, :, None], axis=2, bitorder="little")[:, :, :bits].reshape(len(low), -1)
    raw = np.packbits(flat, axis=1, bitorder="little")
    return np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8))).view("<i8")


def band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key of each band's minima; a row for each set."""
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(low), bands))
    for j in range(rows):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + low[:, j::rows].astype(np.uint64))
    return h.view(np.int64)


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def features(docs: DataFrame, width: int, bands: int, rows: int, bits: int) -> DataFrame:
    def one(batch: pa.RecordBatch) -> list[tuple]:
        sets = [shingle_set(text.as_py(), width) for text in batch["text"]]
        low = np.array([minima(s, bands * rows) for s in sets]).reshape(len(sets), -1)
        out = []
        known = zip(*(batch[c].to_pylist() for c in ("doc_id", "row_1", "row_2")), strict=True)
        for row, s, signature, keys in zip(known, sets, packed(low, bits), band_keys(low, bands, rows), strict=True):
            digest = digest_of(s)
            out.append((*row, len(s), digest, signature, keys) if len(s) else (*row, 0, None, None, None))
        return out

    one_key, two_key = row_keys(docs)
    return map_rows(docs.select("doc_id", "text", one_key.alias("row_1"), two_key.alias("row_2")), one, FEATURES)


def sets_of(docs: DataFrame, width: int, minima_of: int = 0) -> DataFrame:
    """digest, n_shingles, the set, and ``fine``: one bit of each of ``minima_of`` minima."""

    def one(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for text in batch["text"]:
            s = shingle_set(text.as_py(), width)
            fine = packed(minima(s, minima_of)[None, :], 1)[0] if minima_of else []
            out.append((digest_of(s), len(s), s.tobytes(), fine))
        return out

    return map_rows(docs.select("text"), one, "digest binary, n_shingles bigint, items binary, fine array<bigint>")


def estimate(a: list[Column], b: list[Column], n: int, bits: int) -> Column:
    """Similarity from packed signatures: the share of agreeing minima, less what agrees by chance."""
    ones = sum(1 << i for i in range(0, 64, bits))
    mask = F.lit(ones - (1 << 64) if ones >> 63 else ones)

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        any_bit = d
        for i in range(1, bits):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(d, i))
        return F.bit_count(any_bit.bitwiseAND(mask))

    wrong = sum((unequal(x, y) for x, y in zip(a, b, strict=True)), F.lit(0))
    chance = 2.0**-bits
    return ((F.lit(n) - wrong) / F.lit(n) - F.lit(chance)) / F.lit(1 - chance)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, counted on the full sets."""

    def one(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for a, b, x, y in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["x"], batch["y"], strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            union = len(np.union1d(x, y))
            if 100 * (len(x) + len(y) - union) >= percent * union:
                out.append((a, b))
        return out

    x = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return map_rows(pairs.select("a", "b").join(x, "a").join(y, "b"), one, "a bigint, b bigint")


def least_estimate(percent: int, n: int, bits: int) -> float:
    """Five standard errors under the threshold, for ``n`` minima of ``bits`` bits."""
    chance, true = 2.0**-bits, percent / 100
    agree = true + (1 - true) * chance
    return true - 5 * (agree * (1 - agree) / n) ** 0.5 / (1 - chance)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 52, rows: int = 7, bits: int = 2, fine: int = 4096
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    out = labelled(docs, width, percent, bands, rows, bits, fine).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def labelled(
    docs: DataFrame, width: int, percent: int, bands: int = 52, rows: int = 7, bits: int = 2, fine: int = 4096
) -> DataFrame:
    """For each row of ``docs``: doc_id, row_1, row_2, n_shingles, component_id, and ``component``, a number that its group
    shares (null for rows without a set or an id, which have no group)."""
    n, sites = bands * rows, site_count(docs.sparkSession)
    feats = staged(features(docs, width, bands, rows, bits), "minhash")
    own = feats.select("doc_id", "row_1", "row_2", "n_shingles", "digest", site_of(F.col("doc_id"), sites).alias("site"))
    sets_in = own.where("digest IS NOT NULL AND doc_id IS NOT NULL").withColumn("best", F.bitwise_not("doc_id"))
    # a class for each set: the smallest of its ids, and a number
    classes = ascend(sets_in, ["digest"], "best", sites).select(
        "digest", F.bitwise_not("best").alias("rep"), F.monotonically_increasing_id().alias("node")
    )
    classes = staged(classes, "classes")

    # the signature and the bands of each class: those of a row with its set and that id
    stands = classes.select("digest", F.col("rep").alias("doc_id"), "node")
    reps = feats.where("digest IS NOT NULL").join(stands, ["digest", "doc_id"]).drop("digest", "doc_id").dropDuplicates(["node"])
    keys = reps.select("node", F.posexplode("bands").alias("index", "band"))
    # leaders are drawn by a hash, so that the buckets of a cluster share a few of them
    draw = F.struct(F.xxhash64("node", F.lit("leader")).alias("draw"), F.col("node").alias("leader"))
    buckets = keys.groupBy("band").agg(F.min(draw).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(keys.join(buckets.select("band", F.col("first.leader").alias("leader")), "band"), "buckets")

    def fits(x: Column, y: Column) -> Column:
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    def sets_for(nodes: DataFrame, minima_of: int, name: str) -> DataFrame:
        """The sets of some classes, from the texts of the ids that stand for them."""
        wanted = staged(only_ids(classes, nodes, "node"), "wanted")
        texts = only_ids(docs, wanted.select(F.col("rep").alias("doc_id")), "doc_id")
        found = sets_of(texts, width, minima_of).join(wanted.select("digest", "node"), "digest").drop("digest")
        return staged(found.dropDuplicates(["node"]), name)

    # each member against its leaders, the most similar one first
    star = members.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    star = staged(star, "star")
    signatures = reps.select("node", "n_shingles", "signature")
    few = staged(only_ids(signatures, star.select(F.explode(F.array("a", "b")).alias("node")), "node"), "signatures")
    x = few.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    y = few.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    sa, sb = ([F.col(c)[i] for i in range((n * bits + 63) // 64)] for c in ("sa", "sb"))
    star = star.join(x, "a").join(y, "b").where(fits(F.col("na"), F.col("nb")))
    star = star.select("a", "b", estimate(sa, sb, n, bits).alias("estimate"))
    star = staged(star.where(F.col("estimate") >= least_estimate(percent, n, bits)), "close")
    sets = sets_for(star.select(F.explode(F.array("a", "b")).alias("node")), 0, "sets")
    nearest = star.groupBy("a").agg(F.max(F.struct("estimate", "b")).alias("top")).select("a", F.col("top.b").alias("b"))
    links = staged(confirmed(nearest, sets, percent), "links")

    def component_of(df: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
        labels = labels.select(F.col("node").alias(column), F.col("component").alias("labelled"))
        return df.join(labels, column, "left").withColumn(name, F.coalesce("labelled", column)).drop("labelled")

    # the other leaders of members that they would join to another component
    first = components(links)
    others = component_of(component_of(star.select("a", "b"), "a", first, "ca"), "b", first, "cb").where("ca != cb")
    links = links.unionByName(staged(confirmed(others, sets, percent), "other_links"))
    first = components(links)

    # buckets that hold several components still: the pairs across components, once each, with finer signatures
    in_component = component_of(members.drop("leader"), "node", first, "component")
    mixed = in_component.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    mixed = staged(in_component.join(mixed.select("band"), "band", "left_semi"), "mixed")
    sets = sets_for(mixed, fine, "mixed_sets")
    words = (fine + 63) // 64
    short = reps.select("node", F.transform("bands", lambda k: F.hash(k)).alias("keys"))
    rows_in = mixed.join(sets.select("node", "n_shingles", *(F.col("fine")[i].alias(f"s{i}") for i in range(words))), "node")
    rows_in = staged(rows_in.join(short, "node"), "across")
    sx, sy = ([F.col(f"{t}.s{i}") for i in range(words)] for t in "xy")
    before = F.zip_with(F.slice("x.keys", 1, F.col("x.index")), F.slice("y.keys", 1, F.col("x.index")), lambda p, q: p == q)
    pair = (F.col("x.band") == F.col("y.band")) & (F.col("x.component") < F.col("y.component"))
    pair = pair & fits(F.col("x.n_shingles"), F.col("y.n_shingles"))
    pair = pair & (estimate(sx, sy, fine, 1) >= least_estimate(percent, fine, 1))
    pair = pair & ~F.exists(before, lambda same: same)  # else the pair has met in an earlier band
    across = rows_in.alias("x").join(rows_in.alias("y"), pair).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    final = components(links.unionByName(confirmed(across, sets, percent)))

    # the smallest id of each component, and so of its classes
    linked = staged(final.join(classes.select("node", "rep"), "node"), "linked")
    smallest = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = linked.join(smallest, "component").select("node", "component", "component_id")
    labels = classes.join(named, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "rep").alias("component_id")
    )
    rows_out = ["doc_id", "row_1", "row_2", "n_shingles", "component_id", "component"]
    grouped = descend(sets_in.drop("best"), labels, ["digest"]).select(rows_out)
    alone = own.where("digest IS NULL OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    return grouped.unionByName(alone.withColumn("component", F.lit(None).cast("bigint")).select(rows_out))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, one of each group, with all their columns.

    Of a group the row with the smallest id stays; where that id has several texts in the group, one of them. Rows that
    repeat id and text stay or go together. Only the keys of the rows that go meet the texts.
    """
    rows = staged(labelled(docs, width, percent), "labelled").where("component IS NOT NULL")
    stays = F.min(F.struct("doc_id", "row_1", "row_2")).alias("first")
    first = rows.groupBy("component").agg(stays).select("first.row_1", "first.row_2")
    gone = rows.select("row_1", "row_2").join(first, ["row_1", "row_2"], "left_anti").distinct()
    return match_rows(docs, staged(gone, "gone"), "left_anti")
