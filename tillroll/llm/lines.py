"""Removal of boilerplate lines: those that occur on many sites.

1. Every line's sites are counted by a HyperLogLog sketch per line hash; the sketches merge by aggregation, so a line
   that is everywhere costs one sketch per task. Most lines end here: their estimate is clearly under ``min_sites``.
2. The occurrences of all other lines are gathered by a second pass. Lines whose estimate is within four standard errors
   of the threshold get an exact distinct count; those beyond are boilerplate already.
3. Each document loses its boilerplate lines. Only hashes and places travel; a text is joined with the places of its own
   boilerplate lines and loses them in one pass, so the work is linear in the lines of a text.

Lines are compared without the blanks, tabs and carriage returns around them, by 128 bits of hash. An estimate is over
four standard errors off for about one in 30,000 of the lines that lie right there (13 % from the threshold), and small
counts, as the default's, are nearly exact; such a line would be judged by its estimate.

Defined results: a null text stays null, with no lines; blank lines are never removed; a null site is no site; a document
that consists of boilerplate becomes an empty text; repeated rows count once per site and are cleaned alike, and rows that
repeat an id, or have none, each by their own text; an empty table gives an empty result; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_keys, staged

LOG_K = 10


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(bare).alias("h1"), F.xxhash64(bare, F.lit("second")).alias("h2"))


def occurrences(docs: DataFrame, site_col: str) -> DataFrame:
    """Keys of the row, site, place and the key of every line that isn't blank."""
    one, two = row_keys(docs)
    # two steps, so that the text itself doesn't go with each of its lines
    split = docs.select(one.alias("row_1"), two.alias("row_2"), F.col(site_col).cast("string").alias("site"), F.split("text", "\n").alias("lines"))
    rows = split.select("row_1", "row_2", "site", F.posexplode("lines").alias("pos", "line"))
    return rows.where(F.btrim("line", F.lit(" \t\r")) != "").select("row_1", "row_2", "site", "pos", line_key(F.col("line")).alias("key"))


def suspects(docs: DataFrame, site_col: str, min_sites: int) -> DataFrame:
    """key and ``near`` (whether an exact count is needed) of the lines whose estimate isn't clearly under ``min_sites``."""
    error = 4 * 1.04 / (1 << LOG_K) ** 0.5
    found = occurrences(docs, site_col).where("site IS NOT NULL").groupBy("key").agg(
        F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch")
    )
    found = found.select("key", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites * (1 - error))
    return found.select("key", (F.col("sites") <= min_sites * (1 + error)).alias("near"))


def boilerplate_hits(docs: DataFrame, site_col: str, min_sites: int) -> DataFrame:
    """Keys of the row and place of every boilerplate line in every document."""
    few = staged(suspects(docs, site_col, min_sites), "suspects")
    hits = staged(occurrences(docs, site_col).join(few, "key"), "hits")
    exact = hits.where("near AND site IS NOT NULL").groupBy("key").agg(F.count_distinct("site").alias("sites"))
    sure = few.where("NOT near").select("key").unionByName(exact.where(F.col("sites") >= min_sites).select("key"))
    return hits.join(sure, "key", "left_semi").select("row_1", "row_2", "pos")


def remove_boilerplate(docs: DataFrame, site_col: str = "source", min_sites: int = 8) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, a site): doc_id, text without boilerplate, n_lines, n_removed."""
    gone = boilerplate_hits(docs, site_col, min_sites).groupBy("row_1", "row_2").agg(F.collect_list("pos").alias("gone"))
    one, two = row_keys(docs)
    # the lines are made before the join, so that nothing after it splits a text once more for each line
    rows = docs.select("doc_id", one.alias("row_1"), two.alias("row_2"), F.split("text", "\n").alias("lines"))
    rows = rows.join(gone, ["row_1", "row_2"], "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    rows = rows.withColumn("left", F.when(F.col("gone").isNotNull(), places))
    kept = F.transform("left", lambda i: F.get("lines", i))
    n = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("bigint")
    removed = F.when(F.col("left").isNull(), 0).otherwise(F.size("lines") - F.size("left")).cast("bigint")
    clean = F.array_join(F.coalesce(kept, F.col("lines")), "\n")
    return rows.select("doc_id", clean.alias("text"), n.alias("n_lines"), removed.alias("n_removed"))
