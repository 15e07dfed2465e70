"""A corpus pipeline: language filter, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``docs``.
"""

from tillroll.llm import exact_dedup, langid, minhash, mixing, packing
from tillroll.llm.common import staged
from tillroll.llm.registry import TARGETS, quality_labels


def language(spark, docs, sf_dir):
    """Drops documents without a letter and those that lie far from every language that the labelled ones teach."""
    return langid.drop_rejected(docs, langid.fit(docs))


def exact(spark, docs, sf_dir):
    """Keeps one document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark, docs, sf_dir):
    """Keeps one document of each group of near duplicates: five words, similarity 0.8 or more."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def mixture(spark, docs, sf_dir):
    """Takes documents so that the expected tokens of the quality domains meet the target shares."""
    return mixing.mix(docs, quality_labels(spark, sf_dir), TARGETS, max_rate=1.0)


def packed(spark, docs, sf_dir):
    """Packs the documents into sequences of 2048 tokens."""
    return packing.pack(packing.pieces(docs))


STAGES = [("langid", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("packing", packed)]

#: SQL can't express the classifiers and the packing.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
