"""Mixing to target weights by soft membership. DataFrame functions only.

1. Each document gets its tokens (words) and the shares of some character classes.
2. The labelled documents give each domain's mean and variance of these features, in one aggregate over all labels; a
   Gaussian naive Bayes classifier turns a document's features into posteriors of the domains.
3. Document i has rate w_i >= 0. The expected tokens of domain d are sum_i w_i * tokens_i * p_id, and the rates shall
   bring them to the targets. Projected gradient descent on the least squares of the misses, in the metric of the
   tokens and with the misses whitened by M = sum_i tokens_i * p_i * p_i' (so a step of 1 is safe):
   w_i <- clip(w_i - p_i' M^-1 miss, 0, max_rate). A document's rate is thus a function of its posteriors and the misses
   so far, so documents are first summed by posteriors, rounded to ``decimals``; each step is one aggregate over those
   sums, and only a number per domain reaches the driver.

Defined results: a null or blank text has no tokens; its posteriors come from zero shares, and it changes no total; a
domain without labelled rows gets posterior 0, and without any labels all get the same; labels that are null or no
domain are ignored; a document with several labels teaches each; rows that repeat an id are rated each by its own text;
an empty table gives an empty result; other columns pass through ``mix`` unchanged.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import match_rows, row_keys, staged, unused

#: Character classes whose shares are features.
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "mark": "[!-/:-@\\[-`{-~]"}
SHARES = [*CLASSES, "word", "line"]
ROW = ["doc_id", "row_1", "row_2", "tokens"]


def shares(docs: DataFrame) -> DataFrame:
    """doc_id, keys of the row, tokens, and the shares: of character classes, mean word length, and lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one, two = row_keys(docs)
    rows = docs.select(
        "doc_id",
        one.alias("row_1"),
        two.alias("row_2"),
        F.length(text).alias("chars"),
        F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("bigint").alias("tokens"),
        F.regexp_count(text, F.lit("\n")).alias("lines"),
        *(F.regexp_count(text, F.lit(c)).alias(f"n_{k}") for k, c in CLASSES.items()),
    )
    size = F.greatest(F.col("chars"), F.lit(1))
    return rows.select(
        *ROW,
        *(F.sqrt(F.col(f"n_{k}") / size).alias(k) for k in CLASSES),
        F.log1p(size / F.greatest(F.col("tokens"), F.lit(1))).alias("word"),
        F.sqrt(F.col("lines") / size).alias("line"),
    )


def fit(rows: DataFrame, labels: DataFrame, domains: list[str]) -> dict[str, dict]:
    """Prior, means and variances of each domain that has labelled rows, over all labelled rows (doc_id, domain)."""
    known = labels.where(F.col("domain").isin(domains)).select(F.col("doc_id").alias("id"), "domain")
    both = rows.join(known, rows["doc_id"] == known["id"])
    stats = [f(c).alias(f"{n}_{c}") for c in SHARES for n, f in (("mean", F.avg), ("var", F.var_pop))]
    found = both.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *stats).collect()  # a row for each domain
    total = sum(r["n"] for r in found)
    return {r["domain"]: {"prior": r["n"] / total, **{c: (r[f"mean_{c}"], r[f"var_{c}"] + 1e-4) for c in SHARES}} for r in found}


def posteriors(rows: DataFrame, model: dict[str, dict], domains: list[str], decimals: int) -> DataFrame:
    """doc_id, keys of the row, tokens, and ``p``, the posteriors in the order of ``domains``."""

    def log_score(d: str) -> Column:
        if d not in model:
            return F.lit(0.0 if not model else -1e6)
        score = F.lit(float(np.log(model[d]["prior"])))
        for c in SHARES:
            mean, var = model[d][c]
            score = score - F.pow(F.col(c) - mean, F.lit(2.0)) / (2 * var) - 0.5 * float(np.log(var))
        return score

    scored = rows.select(*ROW, F.array(*map(log_score, domains)).alias("s"))
    scored = scored.withColumn("top", F.array_max("s")).withColumn("e", F.transform("s", lambda s: F.exp(s - F.col("top"))))
    norm = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return scored.withColumn("norm", norm).select(*ROW, F.transform("e", lambda e: F.round(e / F.col("norm"), decimals)).alias("p"))


def rate_of(p: Column, steps: list[np.ndarray], max_rate: float | None) -> Column:
    """The rate after ``steps`` (a correction per domain each), from 1."""
    rate = F.lit(1.0)
    for step in steps:
        rate = rate - sum((p[i] * float(v) for i, v in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate if max_rate is None else F.least(F.lit(float(max_rate)), rate))
    return rate


def rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    total_tokens: float | None = None,
    max_rate: float | None = None,
    decimals: int = 2,
    rounds: int = 25,
    tolerance: float = 1e-4,
) -> DataFrame:
    """For each row of ``docs``: doc_id, tokens, p, rate. ``targets`` holds the wanted share of tokens of each domain.

    ``total_tokens`` is the wanted sum; by default the largest that needs no domain more often than it is there.
    """
    return rated(docs, labels, targets, total_tokens, max_rate, decimals, rounds, tolerance).drop("row_1", "row_2")


def rated(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    total_tokens: float | None = None,
    max_rate: float | None = None,
    decimals: int = 2,
    rounds: int = 25,
    tolerance: float = 1e-4,
) -> DataFrame:
    """As :func:`rates`, with the keys of the rows, row_1 and row_2."""
    domains = list(targets)
    share = np.array([targets[d] for d in domains], float)
    share = share / share.sum()
    rows = staged(shares(docs), "shares")
    model = fit(rows, labels, domains)
    rows = staged(posteriors(rows, model, domains, decimals), "posteriors")
    cells = staged(rows.groupBy("p").agg(F.sum("tokens").cast("double").alias("tokens")), "cells")

    def totals(weight: Column, *columns: Column) -> np.ndarray:
        found = cells.agg(*(F.sum(weight * c) for c in columns)).first()
        return np.array([v or 0.0 for v in found])

    p = [F.col("p")[i] for i in range(len(domains))]
    pairs = totals(F.col("tokens"), *(a * b for a in p for b in p)).reshape(len(domains), -1)
    now = totals(F.col("tokens"), *p)
    everything = max(now.sum(), 1.0)
    if total_tokens is None:
        there = (now > 0) & (share > 0)
        total_tokens = (now[there] / share[there]).min() if there.any() else 0.0
    whiten = np.linalg.pinv(pairs / everything + 1e-6 * np.eye(len(domains)))
    steps: list[np.ndarray] = []
    for _ in range(rounds if now.any() else 0):
        miss = (totals(F.col("tokens") * rate_of(F.col("p"), steps, max_rate), *p) - share * total_tokens) / everything
        if np.abs(miss).max() < tolerance:
            break
        steps.append(whiten @ miss)
    return rows.withColumn("rate", rate_of(F.col("p"), steps, max_rate))


def copies(rate: Column, doc_id: Column) -> Column:
    """How often a document is taken: its rate, rounded up or down by a hash of its id, so that the mean is the rate."""
    draw = F.pmod(F.xxhash64(doc_id, F.lit("copies")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(rate + draw).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], max_rate: float | None = 1.0) -> DataFrame:
    """The documents as often as their rates say, with all their columns.

    Rows are told apart by id and text. Only the keys of those that go, and of those that are taken several times, meet
    the texts.
    """
    rows = rated(docs, labels, targets, max_rate=max_rate)
    (times,) = unused(docs, "times")
    told = rows.select("row_1", "row_2", copies(F.col("rate"), F.col("doc_id")).alias(times)).where(F.col(times) != 1)
    told = staged(told.distinct(), "taken")
    once = match_rows(docs, told.select("row_1", "row_2"), "left_anti")
    often = match_rows(docs, told.where(F.col(times) > 1), "inner")
    again = often.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return once.unionByName(again.drop(times))
