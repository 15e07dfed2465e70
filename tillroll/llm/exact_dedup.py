"""Exact dedup by a tree merge of sorted digest runs. DataFrame functions only.

Texts are equal when nothing but white space (space, tab to carriage return) sets them apart. Every site (a spread of
the ids) reduces its documents to a run of distinct digests. In binomial rounds, neighbouring sites exchange runs and
merge them, and each merge keeps the best document of every digest, until one run holds the result. ``max`` over a
struct is a sort-based aggregate in Spark, so the runs are sorted and merged in order.

A digest is verified at every level: entries merge only if SHA-256, a second hash with another seed and the length in
bytes agree.

Defined results: a null text counts as empty; all empty texts are one group; a null id loses against every other id;
of equal texts the one with the most code points stays, then the smallest id; rows that repeat an id and a text count as
members, and all carry the same verdict; an empty table gives an empty result; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascend, descend, match_rows, row_keys, site_count, site_of, staged

KEYS = ["text_sha256", "check", "bytes"]
#: The white space that is deleted, space and tab to carriage return.
WHITE = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def normalised(text: Column) -> Column:
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def digests(docs: DataFrame, sites: int) -> DataFrame:
    """A narrow row per document: id, site, keys of the row, the verified digest, and ``best``, largest for the row that stays.

    Of rows that agree in length and id, the one with the largest keys of id and text stays.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one, two = row_keys(docs)
    rows = docs.select("doc_id", one.alias("row_1"), two.alias("row_2"), F.length(text).alias("n"), normalised(text).alias("plain"))
    return rows.select(
        "doc_id",
        "row_1",
        "row_2",
        site_of(F.col("doc_id"), sites).alias("site"),
        F.sha2("plain", 256).alias("text_sha256"),
        F.xxhash64("plain", F.lit("check")).alias("check"),
        F.octet_length("plain").alias("bytes"),
        F.struct(F.col("n"), F.bitwise_not("doc_id").alias("rev"), "row_1", "row_2").alias("best"),  # ~id falls as the id grows
    )


def grouped(docs: DataFrame, fan_in_bits: int) -> tuple[DataFrame, DataFrame]:
    """The digests of all rows, and for each distinct text the row that stays and the number of rows."""
    sites = site_count(docs.sparkSession)
    rows = staged(digests(docs, sites), "digests")
    classes = ascend(rows, KEYS, "best", sites, fan_in_bits).select(
        *KEYS, F.bitwise_not("best.rev").alias("keep_id"), F.col("members").alias("group_size"), "best.row_1", "best.row_2"
    )
    return rows, classes


def exact_duplicates(docs: DataFrame, fan_in_bits: int = 3) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    rows, classes = grouped(docs, fan_in_bits)
    return descend(rows.drop("best", "row_1", "row_2"), classes.drop("row_1", "row_2"), KEYS).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_duplicates(docs: DataFrame, fan_in_bits: int = 3) -> DataFrame:
    """The documents that stay, one of each distinct text, with all their columns.

    Rows are told apart by id and text, so one id may stay with one text and go with another. Rows that repeat both stay
    once. Only the keys of the rows that go, and of those that repeat, meet the texts.
    """
    rows, classes = grouped(docs, fan_in_bits)
    key = ["row_1", "row_2"]
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("times"))
    told = staged(counted.join(classes.select(*key, F.lit(True).alias("stays")), key, "left"), "told")
    left = match_rows(docs, told.where("stays IS NULL").select(*key), "left_anti")
    again = told.where("stays AND times > 1").select(*key)
    once = match_rows(left, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return match_rows(left, again, "left_anti").unionByName(once)
