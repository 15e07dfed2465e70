"""Packing of tokenised documents into sequences, by patterns that non-negative least squares fits to the histogram.

1. Each document is tokenised and ended by one id; only longer ones are cut, and the rest of a division is the first
   piece. So all pieces but the first are full.
2. The histogram of piece lengths (at most ``capacity`` numbers) goes to the driver. Patterns of one to three lengths, or to
   six, that fill a sequence exactly are enumerated, of those of three and more a share, in several sizes. Non-negative
   least squares fits how often each is used; the counts are rounded to what the histogram holds, and what is left is
   packed by best fit, whole groups of equal pieces at a time.
3. Pieces of a length are numbered through, first within (length, site), then by the sites' counts, so that a hot
   length is dealt out over all sites. Piece r of a length takes slot r of that length in the plan.

What reaches the driver is bounded by the capacity, not by the documents.

Defined results: a null or empty text is one piece with the end id alone; rows that repeat an id are packed each; rows
without an id are packed with a null id; an empty table gives an empty result; other columns are ignored.
"""

import base64
import re
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, site_count, staged

CAPACITY = 2048
#: Numbers of middle lengths to try for the patterns of three.
MIDDLES = (8, 32)
#: Numbers of lengths that patterns may have.
MOST = (3, 6)
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: Fixed value: the one special token of the vocabulary.
END_OF_TEXT = "<|endoftext|>"
#: The vocabulary's pattern gives up on white space of about 1,000,000 characters, so runs from this length on go past it.
BLANK_RUN = 500_000
BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@cache
def encoder(path: str, special: int, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The byte-level vocabulary as ranks; gives the same ids as its ``tokenizers`` file, six times as fast."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: special})


def encoded(text: str, vocabulary: str, special: int) -> list[int]:
    """The ids of a text. A run of ``BLANK_RUN`` or more white space is one pre-token, which merges by itself, as in the
    pattern: all of it at the end of the text or before the special token, else all but its last character."""
    whole = encoder(vocabulary, special)
    if len(text) < BLANK_RUN:
        return whole.encode(text, allowed_special="all")
    out, at = [], 0
    for run in re.finditer(f"(?<!{BLANK}){BLANK}{{{BLANK_RUN},}}", text):
        out += whole.encode(text[at : run.start()], allowed_special="all")
        last = run.end() == len(text) or text.startswith(END_OF_TEXT, run.end())
        at = run.end() if last else run.end() - 1
        out += encoder(vocabulary, special, r"\s+").encode_ordinary(text[run.start() : at])
    return out + whole.encode(text[at:], allowed_special="all")


def token_ids(text: str | None, vocabulary: str, special: int = 50256, end: int = 0) -> np.ndarray:
    """The ids of a text, then ``end``. Lone surrogates, which UTF-8 can't hold, count as replacement characters."""
    text = (text or "").encode("utf-8", "replace").decode("utf-8")
    return np.array([*encoded(text, vocabulary, special), end], "<u4")


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32."""

    def one(batch: pa.RecordBatch) -> list[tuple]:
        path, out = public_tokenizers.path(vocabulary), []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            ids = token_ids(text.as_py(), path)
            first = (len(ids) - 1) % capacity + 1
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                out.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
        return out

    return map_rows(docs.select("doc_id", "text"), one, PIECES)


def patterns(lengths: np.ndarray, capacity: int, middles: int, most: int = 3) -> np.ndarray:
    """Rows of up to ``most`` lengths, largest first and 0 for none, that fill a sequence exactly.

    All pairs; of the triples, ``middles`` evenly spread middle lengths for each largest one; and so of the longer patterns,
    which hold the largest length as often as makes two others of at most that length fill the rest.
    """
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    out = [(capacity,)] if there[capacity] else []
    out += [(a, capacity - a) for a in range((capacity + 1) // 2, capacity) if there[a] and there[capacity - a]]
    for a in lengths[lengths < capacity]:
        for times in range(1, most - 1):
            rest = capacity - times * a
            if not 2 <= rest <= 2 * a:
                continue
            b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
            b = b[there[b] & there[rest - b]]
            for m in b[np.unique(np.linspace(0, len(b) - 1, min(middles, len(b))).astype(int))] if len(b) else []:
                out.append((a,) * times + (m, rest - m))
    table = np.zeros((len(out), most), np.int64)
    for n in {len(x) for x in out}:
        at = [i for i, x in enumerate(out) if len(x) == n]
        table[at, :n] = [out[i] for i in at]
    return table


def least_squares(rows: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """How often to use each pattern: accelerated projected gradient on |patterns * counts - histogram|, counts >= 0."""
    if not len(rows):
        return np.zeros(0)
    uses = np.bincount(rows.ravel(), minlength=len(histogram)).astype(float)
    uses[0] = 0
    scale = 1 / np.sqrt(np.maximum(uses, 1))  # rows of the system that many patterns use weigh less
    weight = (scale**2)[rows] * (rows > 0)
    step = 1 / rows.shape[1]  # safe: each length's weight is one over its uses, so a pattern sees at most its own lengths
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        made = sum(np.bincount(rows[:, j], y, len(histogram)) for j in range(rows.shape[1]))
        miss = made - histogram
        new = np.maximum(0, y - step * (weight * miss[rows]).sum(axis=1))
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        x, y = new, new + (old - 1) / t * (new - x)
    return x


def plan(
    histogram: np.ndarray, capacity: int = CAPACITY, middles: tuple[int, ...] = MIDDLES, most: tuple[int, ...] = MOST
) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences); uses up ``histogram``, the count of each length from 0.

    Of the plans with each number of ``middles`` and of lengths in a pattern the one with the fewest sequences: more patterns
    fit closer, but each is used less often then, and rounding takes more of it away. None is tried after one that takes no
    more sequences than the lengths need in all.
    """
    least = -(-int((np.arange(len(histogram)) * histogram).sum()) // capacity)
    plans: list[list[tuple[tuple[int, ...], int]]] = []
    for n, m in ((n, m) for n in most for m in middles):
        plans.append(fitted(histogram, capacity, m, n))
        if sum(times for _, times in plans[-1]) == least:
            break
    return shortest(plans)


def plan_or_best_fit(histogram: np.ndarray, capacity: int = CAPACITY, middles: tuple[int, ...] = MIDDLES) -> list[tuple[tuple[int, ...], int]]:
    """A plan, or best fit for everything where that takes fewer sequences."""
    whole = histogram.astype(np.int64).copy()
    whole[0] = 0
    return shortest([plan(histogram, capacity, middles), best_fit(whole, capacity)])


def shortest(plans: list[list[tuple[tuple[int, ...], int]]]) -> list[tuple[tuple[int, ...], int]]:
    return min(plans, key=lambda chosen: sum(n for _, n in chosen))


def fitted(histogram: np.ndarray, capacity: int, middles: int, most: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """A plan from the patterns that ``middles`` and ``most`` give, and best fit for what they leave.

    The counts are rounded in several ways, of which the one with the fewest sequences stays.
    """
    whole = histogram.astype(np.int64).copy()
    whole[0] = 0
    rows = patterns(np.flatnonzero(whole), capacity, middles, most)
    x = least_squares(rows, whole.astype(float))
    up = np.ceil(x - 1e-6)
    short = np.array([len(set(r[r > 0])) < 3 for r in rows], bool)
    roundings = (np.where(short, up, np.round(x)), np.where(x >= 0.5, up, 0), up)
    return shortest([rounded(whole, capacity, rows, x, n) for n in roundings])


def rounded(whole: np.ndarray, capacity: int, rows: np.ndarray, x: np.ndarray, wanted: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Each pattern as often as ``wanted`` and as the lengths that are left allow, the most used first; then best fit."""
    left = whole.copy()
    out: list[tuple[tuple[int, ...], int]] = []
    for i in np.argsort(-x, kind="stable"):
        if wanted[i] > 0:
            lengths, times = np.unique(rows[i][rows[i] > 0], return_counts=True)
            n = min(int(wanted[i]), int((left[lengths] // times).min()))
            if n > 0:
                left[lengths] -= n * times
                out.append((tuple(int(v) for v in rows[i] if v), n))
    return out + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, for all pieces of a length at once: groups of equal sequences are filled together."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length]) if length < len(left) else 0
        while n:
            fit = min((r for r, groups in room.items() if r >= length and groups), default=None)
            if fit is None:
                per = capacity // length
                for times, of in ((per, n // per), (n % per, 1)):
                    if times and of:
                        room.setdefault(capacity - times * length, []).append(((length,) * times, of))
                n = 0
                break
            lengths, of = room[fit].pop()
            take = min(n, of)
            if take < of:
                room[fit].append((lengths, of - take))
            room.setdefault(fit - length, []).append(((*lengths, length), take))
            n -= take
    return [g for groups in room.values() for g in groups]


def slots(chosen: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """The plan as runs of slots in order of (length, first rank): length, first, sequence, offset."""
    filled = np.zeros(capacity + 1, np.int64)
    out, sequence = [], 0
    for lengths, n in chosen:
        offset = 0
        for length in lengths:
            out.append((length, filled[length], sequence, offset))
            filled[length] += n
            offset += length
        sequence += n
    table = np.array(sorted(out), np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T, strict=True))


def numbered(rows: DataFrame, sites: int) -> DataFrame:
    """``rank``: each piece's number among those of its length, from 0."""
    dealt = rows.withColumn("site", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(sites)))
    local = dealt.withColumn("local", F.row_number().over(Window.partitionBy("length", "site").orderBy("doc_id", "piece")))
    sizes = dealt.groupBy("length", "site").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("site").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")  # a row for each site at most
    return local.join(sizes, ["length", "site"]).withColumn("rank", F.col("before") + F.col("local") - 1)


def pack(rows: DataFrame, capacity: int = CAPACITY, middles: tuple[int, ...] = MIDDLES) -> DataFrame:
    """``rows`` of pieces with the sequence and the place in it that each gets."""
    rows = staged(rows, "pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # capacity rows at most
        histogram[r["length"]] = r["n"]
    runs = slots(plan_or_best_fit(histogram, capacity, middles), capacity)
    shift, names = np.int64(1 << 44), rows.columns
    starts = runs["length"] * shift + runs["first"]

    def place(batch: pa.RecordBatch) -> list[tuple]:
        rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
        run = np.searchsorted(starts, length * shift + rank, side="right") - 1
        sequence = runs["sequence"][run] + rank - runs["first"][run]
        kept = (batch[c].to_pylist() for c in names)
        return list(zip(*kept, sequence.tolist(), runs["offset"][run].tolist(), strict=True))

    placed = numbered(rows, site_count(rows.sparkSession)).select(*names, "rank")
    return map_rows(placed, place, f"{PIECES}, sequence_id bigint, offset bigint")
