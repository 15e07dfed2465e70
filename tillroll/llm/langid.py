"""Language identification by nearest centroids.

A text becomes the counts of its letter n-grams (one to three letters, lower case, words padded by one blank), hashed
into ``DIM`` buckets, damped, weighted by inverse document frequency and normalised. Every language has several
centroids, from spherical k-means over its training texts. A text gets the language of the centroid with the largest
cosine. It is rejected if its cosine is under ``rejection`` times the least that any training text has to its nearest
centroid. Short texts lie far out by nature, so the margin is wide.

Fitting uses at most ``per_language`` labelled texts of each language (a bound on the classifier's sample, drawn by
hash); prediction covers every text, whole.

Defined results: ``und``, score 0 and rejected for a null text or one without a letter, and for all texts if nothing was
learned; rows without language or id teach nothing; more languages than ``most_languages`` are refused by name; repeated rows get the same verdict; ties go to the first language in
order; an empty table gives an empty result; other columns are ignored.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, ship, staged

BITS = 13
DIM = 1 << BITS
PIECE = 1 << 20
ROWS = 128


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower case, and whether that is a letter."""
    lower = np.arange(0x110000, dtype=np.uint32)
    alpha = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            alpha[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return lower, alpha


def _hash(grams: np.ndarray) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket's n-grams occur in the whole text; None without a letter."""
    lower, alpha = _letters()
    total = None
    for at in range(0, len(text or ""), PIECE):
        cp = np.frombuffer(text[max(0, at - 2) : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = alpha[cp]
        if not letter.any():
            continue
        cp = np.where(letter, lower[cp], np.uint32(32)).astype(np.uint64)
        before = np.concatenate(([at > 0], letter[:-1]))
        cp = np.concatenate(([np.uint64(32)], cp[letter | before], [np.uint64(32)]))
        two = (cp[:-1] << np.uint64(21)) | cp[1:]
        three = (two[:-1] << np.uint64(21)) | cp[2:]
        new = np.bincount(_hash(cp), minlength=DIM) + np.bincount(_hash(two), minlength=DIM) + np.bincount(_hash(three), minlength=DIM)
        total = new if total is None else total + new
    return total


def damped(c: np.ndarray) -> np.ndarray:
    return np.sqrt(c, dtype=np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; ``x`` has unit rows."""
    seeds = [unit(x.mean(axis=0))]
    for _ in range(min(k, len(x)) - 1):
        seeds.append(x[np.argmin(np.max(x @ np.array(seeds).T, axis=1))])
    c = np.array(seeds)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([unit(x[own == j].mean(axis=0)) if (own == j).any() else c[j] for j in range(len(c))])
    return c


def held_out():
    """Rows that teach nothing: the CRC-32 of the id as text is divisible by five."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, per_language: int, most_languages: int = 1000) -> DataFrame:
    """At most ``per_language`` rows (lang, text) of each language, drawn by a hash of the id.

    More than ``most_languages`` languages are refused, since each takes its place in the model.
    """
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = staged(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    if (n := sizes.count()) > most_languages:
        raise ValueError(f"{n} languages to learn, most_languages is {most_languages}")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    few = rows.join(F.broadcast(sizes), "lang").where(draw * F.col("n") < 1.2 * per_language + 50)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    return few.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_language).select("lang", "text")


class Model:
    """Languages, their centroids as unit rows, the weight of each bucket, and the least cosine that is accepted."""

    def __init__(self, idf, languages, centroids, least):
        self.idf, self.languages, self.centroids, self.least = idf, languages, centroids, least

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        found = [counts(t) for t in texts]
        x = np.zeros((len(texts), DIM), np.float32)
        for i, c in enumerate(found):
            if c is not None:
                x[i] = damped(c)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosines = unit(x * self.idf) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        known = np.array([c is not None for c in found], bool)
        score = np.where(known, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0).astype(float)
        names = [self.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
        return names, score, ~known | (score < self.least)


def fit(
    docs: DataFrame, per_language: int = 500, clusters: int = 4, rejection: float = 0.35, most_languages: int = 1000
) -> Model:
    """A model of the labelled rows that may teach. ``rejection``: see above; ``most_languages`` bounds the model's size."""

    def vectors(batch: pa.RecordBatch) -> list[tuple]:
        found = ((lang.as_py(), counts(text.as_py())) for lang, text in zip(batch["lang"], batch["text"], strict=True))
        return [(lang, damped(c).tobytes()) for lang, c in found if c is not None]

    def frequencies(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x = np.array([np.frombuffer(v, np.float32) for v in group["vector"]])
        return pd.DataFrame({"lang": [key[0]], "n": [len(x)], "df": [(x > 0).sum(axis=0).astype(np.int32).tobytes()]})

    def centroids(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.array([np.frombuffer(v, np.float32) for v in group["vector"]]) * idf)
        c = k_means(x, clusters)
        least = float((x @ c.T).max(axis=1).min())
        return pd.DataFrame({"lang": key[0], "cluster": range(len(c)), "vector": [v.astype(np.float32).tobytes() for v in c], "least": least})

    sample = staged(map_rows(training_sample(docs, per_language, most_languages), vectors, "lang string, vector binary"), "langid")
    stats = sample.groupBy("lang").applyInPandas(frequencies, "lang string, n bigint, df binary").collect()  # a row for each language
    n = sum(r["n"] for r in stats)
    df = sum((np.frombuffer(r["df"], np.int32) for r in stats), np.zeros(DIM, np.int64))
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.1)
    found = sample.groupBy("lang").applyInPandas(centroids, "lang string, cluster int, vector binary, least double").collect()
    found = sorted(found, key=lambda r: (r["lang"], r["cluster"]))
    matrix = np.array([np.frombuffer(r["vector"], np.float32) for r in found]).reshape(len(found), DIM)
    return Model(idf, [r["lang"] for r in found], matrix, rejection * min((r["least"] for r in found), default=0.0))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score, rejected."""

    def one(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for i in range(0, len(batch), ROWS):
            part = batch.slice(i, ROWS)
            names, score, rejected = model.predict(part["text"].to_pylist())
            out += zip(part["doc_id"].to_pylist(), part["held_out"].to_pylist(), names, score.tolist(), rejected.tolist(), strict=True)
        return out

    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return map_rows(rows, one, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that aren't rejected, with all their columns. One pass, no shuffle."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                part = batch.slice(i, ROWS)
                yield part.filter(pa.array(~model.predict(part["text"].to_pylist())[2]))

    ship(docs.sparkSession)
    return docs.mapInArrow(one, docs.schema)
