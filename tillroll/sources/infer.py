"""Types of text columns from one pass over all rows.

Each value has the narrowest of a few kinds (whole number, long, larger whole number, fraction, date, moment, truth value,
text). The kinds that a column holds are a set of bits, so they combine like any aggregate, in any order, and the
column's type is the one that holds them all. The kinds are those of Spark's own inference, but for digits of other
scripts, which are text here.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import scratch_dir
from tillroll.sqltext import identifier

INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, STRING = (1 << i for i in range(8))
_MOST_DIGITS, _DIGITS_OF_INT, _DIGITS_OF_LONG = 38, 10, 20
_WHOLE, _DECIMAL = r"^[+-]?[0-9]+$", r"^[+-]?[0-9]+\.?$"
# What a Double's text may look like, apart from words for infinity.
_FRACTION = r"^[\x00-\x20]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?[\x00-\x20]*$|^[+-]?(NaN|Infinity|Inf)$"


def kind_of(value: Column) -> Column:
    """The kind of a text value; NULL for NULL."""
    whole = value.rlike(_WHOLE)
    kind = F.when(whole & value.try_cast("int").isNotNull(), INT).when(whole & value.try_cast("bigint").isNotNull(), LONG)
    kind = kind.when(value.rlike(_DECIMAL) & (_digits(value) <= _MOST_DIGITS), DECIMAL).when(value.rlike(_FRACTION), DOUBLE)
    kind = kind.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), DATE)
    kind = kind.when(value.rlike("[0-9]") & ~value.rlike(r"^\s|\s$") & value.try_cast("timestamp").isNotNull(), TIMESTAMP)
    kind = kind.when(F.lower(value).isin("true", "false"), BOOLEAN)
    return kind.when(value.isNotNull(), STRING)


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, r"^[+-]?0*|\.$", ""))


def kinds(df: DataFrame) -> list[Column]:
    """Aggregates over text columns: of each the kinds it holds (``kinds_0``, ...) and its longest whole number."""
    columns = [F.col(identifier(c)) for c in df.columns]
    held = [F.bit_or(kind_of(c)).alias(f"kinds_{i}") for i, c in enumerate(columns)]
    return held + [F.max(F.when(c.rlike(_DECIMAL), _digits(c))).alias(f"digits_{i}") for i, c in enumerate(columns)]


def type_of(held: int | None, digits: int | None) -> T.DataType:
    """The narrowest type for all kinds of ``held``; text where they have nothing in common, or where there are none."""
    held = held or STRING
    if held & ~(INT | LONG | DECIMAL | DOUBLE) == 0:
        if held & DOUBLE:
            return T.DoubleType()
        if held & DECIMAL:
            least = _DIGITS_OF_LONG if held & LONG else _DIGITS_OF_INT if held & INT else 0
            return T.DecimalType(max(digits or 1, least), 0)
        return T.LongType() if held & LONG else T.IntegerType()
    if held & ~(DATE | TIMESTAMP) == 0:
        return T.TimestampType() if held & TIMESTAMP else T.DateType()
    return T.BooleanType() if held == BOOLEAN else T.StringType()


def schema_of(names: list[str], found: Mapping[str, int | None]) -> T.StructType:
    return T.StructType([T.StructField(c, type_of(found[f"kinds_{i}"], found[f"digits_{i}"])) for i, c in enumerate(names)])


def infer_text_schemas(datasets: Mapping[str, DataFrame]) -> dict[str, T.StructType]:
    """The schemas of several datasets of text columns, from one job that reads each once."""
    parts = []
    for name, df in datasets.items():
        if df.columns:
            pairs = [F.struct(F.lit(i).alias("i"), F.col(f"kinds_{i}").alias("kinds"), F.col(f"digits_{i}").alias("digits")) for i in range(len(df.columns))]
            parts.append(df.agg(*kinds(df)).select(F.lit(name).alias("dataset"), F.explode(F.array(*pairs)).alias("x")))
    found: dict[str, dict] = {name: {} for name in datasets}
    if parts:
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        for row in every.select("dataset", "x.*").collect():  # a row for each column
            found[row["dataset"]] |= {f"kinds_{row['i']}": row["kinds"], f"digits_{row['i']}": row["digits"]}
    return {name: schema_of(df.columns, found[name]) for name, df in datasets.items()}


def scan_csv_once(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row and inferred types, read once.

    The rows are written as text to the scratch folder, the kinds are gathered in the same pass, and the written rows are
    cast. Every value fits its type, so no cast fails.
    """
    text = spark.read.option("header", True).csv(path)
    if not text.columns:
        return text
    seen, staged = Observation(f"kinds of {path}"), scratch_dir(spark, "text")
    aliases = text.toDF(*(f"c{i}" for i in range(len(text.columns))))  # names that any file format takes
    aliases.observe(seen, *kinds(aliases)).write.parquet(staged)
    schema = schema_of(text.columns, seen.get)
    rows = spark.read.schema(aliases.schema).parquet(staged)
    return rows.select(*(F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)))
