"""Personal data by weak supervision. DataFrame functions only.

1. Patterns find candidates of each kind with their positions: the base patterns, whose valid matches are always
   reported, and looser ones, which are sought in what the base spans of their kind leave. Positions come from splitting a
   text at the matches, so each pattern passes a text twice, and are added up within blocks of matches first.
2. Labelers vote on each candidate (1 for, -1 against, 0 abstains): the strict pattern with its check (digits, ranges,
   Luhn), a gazetteer of endings, prefixes and ranges, and the words before the candidate.
3. The votes are counted by kind and pattern of votes, in one aggregate. Expectation-maximisation over these counts (a
   bounded number) estimates how reliable each labeler is for each kind, and each pattern's probability.
4. These probabilities are the soft labels of the final span classifier, a logistic regression on the votes and on
   features of the span, fitted on counts by kind, votes and features. It decides on the looser candidates.

A document's candidates stay in its row, so after the patterns there is no shuffle but the one of the counts.

Defined results: a null text counts as empty; a looser candidate doesn't overlap a base span of its kind; rows
that repeat are scanned alike; an empty table gives an empty result; other columns are ignored. Offsets are code points,
end exclusive. All patterns are possessive or bound to the start of a run, and a match costs some ``BLOCK`` steps and one
more for each ``BLOCK`` ** 2 matches of its text, so the time is near linear in the text.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KINDS = ["email", "ip", "card", "phone"]
USER = "[A-Za-z0-9._%+-]"
#: Base patterns of the contract, written so that no run of characters is tried twice. A card's number of digits, 16 to
#: 19, is part of its pattern here; 13 to 15 make a looser candidate.
PATTERNS = {
    "email": rf"(?:(?<!{USER})|\G){USER}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{USER}){USER}++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
#: What a text needs to be worth a pass.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
LOOSE_NEEDS = {"email": "(?i)[\\[(]at[\\])]", "ip": "[0-9A-Fa-f]:[0-9A-Fa-f]", "phone": "[0-9]{3}[ .-][0-9]{4}"}
#: The gazetteers, as patterns over a candidate.
GAZETTEER = {
    "email": r"(?i).*[.](com|org|net|edu|gov|info|io|co|de|fr|es|it|nl|uk|eu|ch|at|us)$",
    "ip": r"(?i)^(10|127|172|192|[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])[.]|^[0-9a-f]{1,4}:",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^[+](1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1-6]|9[0-58])[^0-9]|^[(]?[2-9][0-9]{2}",
}
#: Words before a candidate that speak for its kind.
CUES = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|reply|from|to|cc)\b",
    "ip": r"(?i)\b(ip|host|server|address|addr|ping|client|login)\b",
    "card": r"(?i)\b(card|visa|mastercard|credit|debit|pay|payment|account)\b",
    "phone": r"(?i)\b(phone|tel|call|fax|mobile|cell|whatsapp|sms)\b",
}
#: Words before a candidate that speak against any kind.
AGAINST = r"(?i)\b(version|section|isbn|order|serial|invoice|figure|hash|token|sha)\b"
CONTEXT = 24
#: Matches whose positions are added up one by one.
BLOCK = 64
#: A character that no pattern matches.
BLOT = "\x00"
EMPTY = "cast(array() AS array<struct<s: bigint, e: bigint, v: string, c: string>>)"


def found(gaps: Column, hits: Column) -> Column:
    """The matches of a pattern, in order: start, end, value, and the characters before it.

    ``gaps`` and ``hits``, what lies between the matches and the matches, have to be columns: an expression would be
    computed again for each block.
    """
    n = F.size(hits)
    zero = F.lit(0).cast("bigint")

    def total(at: Column, x: Column) -> Column:
        return at + F.length(x["gap"]) + F.length(x["hit"])

    def block(b: Column) -> Column:
        first = b * BLOCK + 1
        return F.arrays_zip(F.slice(gaps, first, F.lit(BLOCK)).alias("gap"), F.slice(hits, first, F.lit(BLOCK)).alias("hit"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: F.filter(block(b), lambda x: x["hit"].isNotNull()))
    ends = F.aggregate(
        F.transform(blocks, lambda pairs: F.aggregate(pairs, zero, total)),
        F.array(zero),
        lambda out, size: F.concat(out, F.array(F.element_at(out, -1) + size)),
    )

    def spans(pairs: Column, base: Column) -> Column:
        start = F.struct(base.alias("at"), F.expr(EMPTY).alias("out"))

        def step(a: Column, x: Column) -> Column:
            s = a["at"] + F.length(x["gap"])
            e = s + F.length(x["hit"])
            span = F.struct(s.alias("s"), e.alias("e"), x["hit"].alias("v"), F.right(x["gap"], F.lit(CONTEXT)).alias("c"))
            return F.struct(e.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

        return F.aggregate(pairs, start, step, lambda a: a["out"])

    told = F.flatten(F.transform(F.arrays_zip(blocks.alias("pairs"), F.slice(ends, F.lit(1), F.size(blocks)).alias("base")), lambda x: spans(x["pairs"], x["base"])))
    return F.when(n > 0, told).otherwise(F.expr(EMPTY))


def without(kind: str, gaps: Column, hits: Column) -> Column:
    """The text with the base spans of a kind blotted out, character by character."""
    blot = F.transform(hits, lambda v: F.when(valid(kind, v), F.repeat(F.lit(BLOT), F.length(v))).otherwise(v))
    pairs = F.arrays_zip(gaps.alias("gap"), blot.alias("hit"))
    return F.array_join(F.transform(pairs, lambda x: F.concat(x["gap"], F.coalesce(x["hit"], F.lit("")))), "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern is a base span."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$")
    if kind == "card":
        return F.when(F.length(digits) >= 16, luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def judged(kind: str, spans: Column, strict: bool) -> Column:
    """Spans with their votes, ``base``, and the features of the final classifier."""

    def one(x: Column) -> Column:
        base = valid(kind, x["v"]) if strict else F.lit(False)
        digits = F.regexp_replace(x["v"], "[^0-9]", "")
        if kind == "card" and strict:
            pattern = F.when(luhn(digits), 1).otherwise(-1)
        else:
            pattern = F.when(base, 1).otherwise(-1) if strict else F.lit(0)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            x["s"].alias("s"),
            x["e"].alias("e"),
            base.alias("base"),
            pattern.cast("int").alias("v1"),
            F.when(x["v"].rlike(GAZETTEER[kind]), 1).otherwise(-1).cast("int").alias("v2"),
            F.when(x["c"].rlike(CUES[kind]), 1).when(x["c"].rlike(AGAINST), -1).otherwise(0).cast("int").alias("v3"),
            F.lit(int(strict)).alias("f1"),
            F.when(x["c"].rlike("[A-Za-z0-9]$"), 1).otherwise(0).cast("int").alias("f2"),
            F.when(x["v"].rlike("[ ().-]"), 1).otherwise(0).cast("int").alias("f3"),
        )

    return F.transform(spans, one)


FEATURES = ["v1", "v2", "v3", "f1", "f2", "f3"]
SPAN = "struct<kind: int, s: bigint, e: bigint, base: boolean, v1: int, v2: int, v3: int, f1: int, f2: int, f3: int>"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: the judged candidates of each row."""
    none, nothing = F.expr(f"cast(array() AS array<{SPAN}>)"), F.expr("cast(array() AS array<string>)")

    def split(text: Column, kind: str, patterns: dict[str, str], has: Column) -> Column:
        gaps = F.when(has, F.split(text, patterns[kind], -1)).otherwise(nothing)
        return F.struct(gaps.alias("gaps"), F.when(has, F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0))).otherwise(nothing).alias("hits"))

    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    strict = {k: split(text, k, PATTERNS, text.contains(NEEDS[k]) if NEEDS[k] else F.lit(True)) for k in KINDS}
    rows = rows.select("doc_id", "text", *(v.alias(k) for k, v in strict.items()))
    left = {k: F.when(F.size(f"{k}.hits") > 0, without(k, F.col(f"{k}.gaps"), F.col(f"{k}.hits"))).otherwise(text) for k in LOOSE}
    rows = rows.select("doc_id", *KINDS, *(v.alias(f"{k}_text") for k, v in left.items()))
    loose = {k: split(F.col(f"{k}_text"), k, LOOSE, F.col(f"{k}_text").rlike(LOOSE_NEEDS[k])) for k in LOOSE}
    rows = rows.select("doc_id", *KINDS, *(v.alias(f"{k}_loose") for k, v in loose.items()))
    parts = []
    for kind in KINDS:
        for name, is_strict in ((kind, True), (f"{kind}_loose", False)):
            if name in rows.columns:
                gaps, hits = F.col(f"{name}.gaps"), F.col(f"{name}.hits")
                parts.append(F.when(F.size(hits) > 0, judged(kind, found(gaps, hits), is_strict)).otherwise(none))
    return rows.select("doc_id", F.concat(*parts).cast(f"array<{SPAN}>").alias("spans"))


#: How often, at most, the pattern's check fails true candidates, and passes false ones.
MOST_FAILED, MOST_PASSED = 0.05, 0.5


@dataclass
class Labelers:
    """Of each kind: the share of true candidates, and how each labeler votes on true and on false ones."""

    prior: np.ndarray
    likes: np.ndarray  # kind, labeler, truth (0 false, 1 true), vote + 1


def reliabilities(counts: dict[tuple[int, int, int, int], int], rounds: int = 500, weight: float = 2.0) -> tuple[Labelers, dict]:
    """Expectation-maximisation over the counts of (kind, votes); gives the labelers and each pattern's probability.

    ``weight`` is the number of pseudo-candidates that each estimate starts from. After each round the check's estimates
    are held on their side of ``MOST_FAILED`` and ``MOST_PASSED``, so that the two classes keep their names.
    """
    prior = np.full(len(KINDS), 0.5)
    # labelers are presumed better than chance, and the pattern with its check better than the others
    agree = np.array([[[0.75, 0.2, 0.05], [0.002, 0.298, 0.7]], *2 * [[[0.5, 0.25, 0.25], [0.25, 0.25, 0.5]]]])
    likes = np.broadcast_to(agree, (len(KINDS), 3, 2, 3)).copy()
    keys = sorted(counts)
    p: dict[tuple[int, int, int, int], float] = {}
    for _ in range(rounds):
        for key in keys:
            kind, votes = key[0], key[1:]
            true = prior[kind] * np.prod([likes[kind, j, 1, v + 1] for j, v in enumerate(votes)])
            false = (1 - prior[kind]) * np.prod([likes[kind, j, 0, v + 1] for j, v in enumerate(votes)])
            p[key] = float(true / (true + false))
        total, right = np.full(len(KINDS), weight), np.full(len(KINDS), weight / 2)
        new = np.broadcast_to(weight * agree, likes.shape).copy()
        for key in keys:
            kind, n = key[0], counts[key]
            total[kind] += n
            right[kind] += n * p[key]
            for j, v in enumerate(key[1:]):
                new[kind, j, 1, v + 1] += n * p[key]
                new[kind, j, 0, v + 1] += n * (1 - p[key])
        new /= new.sum(axis=3, keepdims=True)
        for kind in range(len(KINDS)):
            new[kind, 0, 1] = held(new[kind, 0, 1], 0, MOST_FAILED)
            new[kind, 0, 0] = held(new[kind, 0, 0], 2, MOST_PASSED)
        moved = max(np.abs(new - likes).max(), np.abs(right / total - prior).max())
        prior, likes = right / total, new
        if moved < 1e-9:
            break
    return Labelers(prior, likes), p


def held(shares: np.ndarray, vote: int, most: float) -> np.ndarray:
    """Shares of the votes with that of one vote at ``most`` or less; the others keep their proportions."""
    if shares[vote] <= most:
        return shares
    out = shares * (1 - most) / (1 - shares[vote])
    out[vote] = most
    return out


def span_classifier(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 100, penalty: float = 1e-4) -> np.ndarray:
    """Logistic regression of (features, soft label, weight), by Newton's steps: a weight per kind and per kind and feature."""
    width = 1 + len(FEATURES)
    w = np.zeros((len(KINDS), width))
    for kind in range(len(KINDS)):
        own = [r for r in rows if r[0][0] == kind]
        if not own:
            w[kind, 0] = -1.0
            continue
        x = np.array([[1, *r[0][1:]] for r in own], float)
        y, n = np.array([r[1] for r in own]), np.array([r[2] for r in own], float)
        n = n / n.sum()
        ridge = penalty * np.eye(width)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-(x @ w[kind])))
            step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + ridge, x.T @ (n * (p - y)) + ridge @ w[kind])
            w[kind] -= step * min(1.0, 2.0 / np.abs(step).max()) if step.any() else 0.0
            if np.abs(step).max() < 1e-9:
                break
    return w


def fit(spans: DataFrame) -> np.ndarray:
    """The final classifier's weights, from the counts of all candidates' votes and features."""
    each = spans.select(F.explode("spans").alias("x"))
    found = each.groupBy(*(F.col(f"x.{c}").alias(c) for c in ("kind", *FEATURES))).agg(F.count(F.lit(1)).alias("n"))
    found = found.collect()  # a row for each kind, votes and features: bounded by their values
    counts: dict[tuple[int, int, int, int], int] = {}
    for r in found:
        key = (r["kind"], r["v1"], r["v2"], r["v3"])
        counts[key] = counts.get(key, 0) + r["n"]
    _, p = reliabilities(counts)
    return span_classifier(
        [((r["kind"], *(r[f] for f in FEATURES)), p[(r["kind"], r["v1"], r["v2"], r["v3"])], r["n"]) for r in sorted(found)]
    )


def decided(weights: np.ndarray, least: float) -> Column:
    """The accepted spans, by kind and start."""
    spans = F.col("spans")
    cut = float(np.log(least / (1 - least)))

    def score(x: Column) -> Column:
        out = F.lit(0.0)
        for kind, w in enumerate(weights):
            total = F.lit(float(w[0]))
            for name, v in zip(FEATURES, w[1:], strict=True):
                total = total + x[name] * float(v)
            out = F.when(x["kind"] == kind, total).otherwise(out)
        return out

    return F.array_sort(F.filter(spans, lambda x: x["base"] | (score(x) >= cut)))


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data(docs: DataFrame, least: float = 0.9) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = staged(candidates(docs), "pii")
    rows = rows.withColumn("all", decided(fit(rows), least))
    base = F.filter("all", lambda x: x["base"])

    def size_of(kind: int) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint")

    counts = [size_of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("all")).alias("spans"))
