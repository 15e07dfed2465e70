"""The batch jobs: discovery of raw schemas, raw to silver, silver to gold, gold to reports."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.aggregates import count_where, row_count
from tillroll.functions.money import holds_whole
from tillroll.operators.asof import names_as_of, newest_names, newest_rows
from tillroll.operators.cleaning import all_present
from tillroll.operators.joins import BROADCAST_LIMIT_BYTES, measured_bytes
from tillroll.plans.gold import customer_metrics, product_keys, product_metrics
from tillroll.plans.reports import (
    category_performance_analysis,
    customer_activity_analysis,
    customer_purchase_frequency,
    customer_segment_value,
    top_performing_subcategories,
)
from tillroll.plans.silver import REQUIRED, process_customers, process_products, process_transactions
from tillroll.plans.states import customer_state, merged_customers, merged_products, product_customers, product_state
from tillroll.sinks.ddl import create_report_tables, ensure_database, register_table
from tillroll.sinks.publish import publish_snapshots
from tillroll.sinks.tables import bind_table, write_catalog, write_overwrite
from tillroll.sources.drift import apply_drift, catalog_schemas, discover_datasets, infer_schemas, schema_drift
from tillroll.sources.infer import scan_csv_once
from tillroll.sources.scan import CORRUPT_COLUMN, header_schema, scan_catalog, scan_csv, scan_format, scan_parquet
from tillroll.sources.schemas import GOLD, RAW, SILVER
from tillroll.sqltext import TEXT_FORMATS, identifier, table_name

PROCESS = {
    "customers": process_customers,
    "products": process_products,
    "transactions": process_transactions,
}

PRODUCT_ROWS = ("newest", "as_of", "newest_rows", "all")


@dataclass(frozen=True)
class Config:
    """Parameters of a job.

    ``in_path`` and ``out_path`` are folders under ``base_uri``. ``database`` holds the silver and gold tables,
    ``reporting_database`` the reports, ``raw_database`` the raw datasets that discovery finds. ``as_of`` is the load
    and snapshot date, by default the session's current date. ``mode`` 'overwrite' replaces what an earlier run of the
    same day wrote; 'append' adds to it. ``load_date`` makes gold read one day's silver transactions instead of all.

    ``product_rows`` tells which rows of a product count:

    - 'newest', once, as its newest load has it (with ``load_date``, the newest up to that day), so a product that later
      loads lack keeps its transactions;
    - 'as_of': for each transaction as the transaction's own load has it, the newest load not later than it;
    - 'newest_rows': every row of its newest load; a product with several rows there counts its transactions with each;
    - 'all': every row of every load; a product that was loaded twice counts its transactions twice.

    Under the first two a product that only later loads know is taken as the first of them has it, and of several rows
    of a product in one load those with the largest names. ``product_load_date`` takes the products of one load only.
    ``all_product_loads`` is another way to say 'all'.

    ``incremental`` keeps what each day's transactions add to gold in state tables beside it, and gold is the sum of all
    days' states. Only the days that have none yet are read, or, with ``load_date``, that day, whose state is replaced.
    ``bitmaps`` counts distinct customers by bitmaps (see :func:`tillroll.plans.product_metrics`).
    """

    base_uri: str
    in_path: str
    out_path: str
    database: str
    reporting_database: str = "reporting"
    raw_database: str = "raw"
    as_of: date | None = None
    mode: str = "overwrite"
    silver_format: str = "parquet"
    gold_format: str = "parquet"
    infer_schema: bool = False
    load_date: date | None = None
    product_load_date: date | None = None
    product_rows: str = "newest"
    all_product_loads: bool = False
    incremental: bool = False
    bitmaps: bool = False
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES
    product_salts: int = 16

    def source(self, name: str) -> str:
        return f"{self.base_uri.rstrip('/')}/{self.in_path.strip('/')}/{name}"

    def target(self, name: str) -> str:
        return f"{self.base_uri.rstrip('/')}/{self.out_path.strip('/')}/{name}"

    def day(self, spark: SparkSession) -> date:
        """``as_of``, or today: asked once, so that every table of a run carries the same date."""
        return self.as_of or spark.sql("SELECT current_date() AS today").first()["today"]


def run_discovery(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Register every dataset under ``in_path`` with its inferred schema, and follow the changes since the last run.

    Returns the number of columns per action taken.
    """
    ensure_database(spark, cfg.raw_database)
    datasets = discover_datasets(spark, cfg.source(""))
    found = infer_schemas(spark, datasets)
    drift = schema_drift(spark, found, catalog_schemas(spark, cfg.raw_database))
    taken = {row["action"]: row["count"] for row in drift.groupBy("action").count().collect()}
    apply_drift(spark, drift, cfg.raw_database, datasets, found)
    return taken


QUARANTINE = "{}_quarantine"
AUDIT = "load_audit"
_MALFORMED = "_malformed"


def run_silver(spark: SparkSession, cfg: Config) -> dict[str, dict[str, int]]:
    """Clean the three raw CSV files into silver tables, partitioned by ``load_date``.

    Columns are found by their header; ones that aren't declared come through as text and are added to the table.
    Returns the rows read and, under a declared schema, the malformed ones among them, per table. All are counted while
    the rows are written, without another pass.

    Malformed rows (a value that doesn't fit its declared type, too few or too many values) go to ``<table>_quarantine``
    as the lines they were, and whether silver has the row, with NULL for what didn't fit. Only a file that has some is
    read once more for them. ``load_audit`` says what became of each table's rows: those in silver, those without a
    required value, and those that only the quarantine has add up to the rows read.
    """
    ensure_database(spark, cfg.database)
    day, counts, audit = cfg.day(spark), {}, []
    for name, process in PROCESS.items():
        path = cfg.source(f"{name}.csv")
        if cfg.infer_schema:
            raw, bad = scan_csv_once(spark, path), F.lit(False)
        else:
            raw = scan_csv(spark, path, header_schema(spark, path, RAW[name]), corrupt_column=CORRUPT_COLUMN)
            bad = F.col(CORRUPT_COLUMN).isNotNull()
        seen, left = Observation(f"raw {name}"), Observation(f"silver {name}")
        read = raw.observe(seen, row_count().alias("rows"), count_where(bad).alias("malformed"))
        clean = process(read.withColumn(_MALFORMED, bad).drop(CORRUPT_COLUMN), day)
        clean = clean.observe(left, row_count().alias("cleaned"), count_where(F.col(_MALFORMED)).alias("kept"))
        write_catalog(
            clean.drop(_MALFORMED),
            cfg.database,
            name,
            cfg.target(name),
            cfg.silver_format,
            partition={"load_date": day},
            mode=cfg.mode,
        )
        counts[name] = seen.get
        rows, malformed, kept = counts[name]["rows"], counts[name]["malformed"], left.get["kept"]
        audit.append((name, rows, left.get["cleaned"], rows - left.get["cleaned"] - (malformed - kept), malformed - kept, kept))
        _write_quarantine(spark, cfg, name, day, raw.where(bad) if malformed else None)
    told = "dataset string, rows bigint, cleaned bigint, dropped bigint, quarantined bigint, malformed_kept bigint"
    write_catalog(
        spark.createDataFrame(audit, told), cfg.database, AUDIT, cfg.target(AUDIT), partition={"load_date": day}, mode=cfg.mode
    )
    return counts


def _write_quarantine(spark: SparkSession, cfg: Config, name: str, day: date, malformed: DataFrame | None) -> None:
    """The malformed lines of one table and day; none replace those of an earlier run of that day."""
    table = QUARANTINE.format(name)
    bind_table(spark, cfg.database, table, cfg.target(table))
    if malformed is None:
        if cfg.mode == "append" or not spark.catalog.tableExists(table_name(cfg.database, table)):
            return
        lines = spark.createDataFrame([], "line string, in_silver boolean")
    else:
        kept = all_present(malformed, *REQUIRED[name])
        every = F.xxhash64(*(F.col(identifier(c)) for c in malformed.columns))
        lines = malformed.where(F.pmod(every, F.lit(2)) < 2)  # holds always, but only columns that are used are parsed
        lines = lines.select(F.col(CORRUPT_COLUMN).alias("line"), kept.alias("in_silver"))
    write_catalog(lines, cfg.database, table, cfg.target(table), partition={"load_date": day}, mode=cfg.mode)


def run_gold(spark: SparkSession, cfg: Config) -> None:
    """Compute both metrics tables from silver and register them in the catalog.

    Transactions are scanned once per table, each scan with its own few columns: at scale that is cheaper than keeping
    the union of the columns. The names of the products are written first, then measured, and broadcast only if they fit
    ``broadcast_limit_bytes``; beyond it the join is shuffled, with the hot products salted. All load dates of the
    transactions count, unless ``load_date`` picks one. See :class:`Config` for the products and for daily states.
    """
    if cfg.in_path.strip("/") == cfg.out_path.strip("/"):
        raise ValueError("in_path and out_path must differ: gold replaces what lies under its path")
    if cfg.product_rows not in PRODUCT_ROWS:
        raise ValueError(f"product_rows must be one of {PRODUCT_ROWS}, not {cfg.product_rows!r}")
    ensure_database(spark, cfg.database)
    tx, products = _silver(spark, cfg, "transactions"), _silver(spark, cfg, "products")
    gold = _gold_from_states(spark, cfg, tx, products) if cfg.incremental else _gold_from_rows(spark, cfg, tx, products)
    for name, df in gold.items():
        write_overwrite(df, cfg.target(name), cfg.gold_format, database=cfg.database, table=name)


def _gold_from_rows(spark: SparkSession, cfg: Config, tx: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    if cfg.load_date is not None:
        tx = tx.filter(F.col("load_date") == F.lit(cfg.load_date))
    names, by_load = _names(spark, cfg, tx, products, cfg.load_date)
    on = ["product_id", "load_date"] if by_load else ["product_id"]
    fits = measured_bytes(product_keys(names, on)) <= cfg.broadcast_limit_bytes
    chosen = {option: True for option, wanted in (("bitmaps", cfg.bitmaps), ("by_load", by_load)) if wanted}
    return {
        "customer_metrics": customer_metrics(tx),
        "product_metrics": product_metrics(tx, names, products_are_small=fits, salts=cfg.product_salts, **chosen),
    }


def _names(
    spark: SparkSession, cfg: Config, tx: DataFrame, products: DataFrame, until: date | None
) -> tuple[DataFrame, bool]:
    """The names by product, or by product and load date of the transactions, written once and read back; and which."""
    by_load = False
    if cfg.product_load_date is not None:
        names = newest_names(products.filter(F.col("load_date") == F.lit(cfg.product_load_date)))
    elif cfg.all_product_loads or cfg.product_rows == "all":
        names = products
    elif cfg.product_rows == "newest_rows":
        names = newest_rows(products if until is None else products.filter(F.col("load_date") <= F.lit(until)))
    elif cfg.product_rows == "as_of":
        names, by_load = names_as_of(tx, products), True
    elif until is not None:
        names = names_as_of(products.select("product_id", F.lit(until).alias("load_date")), products)
    else:
        names = newest_names(products)
    on = ["product_id", "load_date"] if by_load else ["product_id"]
    path = cfg.target("product_names")
    write_overwrite(names.select(*on, "category", "subcategory"), path)
    return scan_parquet(spark, path), by_load


#: The state tables of incremental gold and what makes them of a day's transactions.
STATES = {"customer_state": customer_state, "product_state": product_state, "product_customers": product_customers}


def _gold_from_states(spark: SparkSession, cfg: Config, tx: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    for name in STATES:
        bind_table(spark, cfg.database, name, cfg.target(name))
    days = [cfg.load_date] if cfg.load_date is not None else _days_without_state(spark, cfg, tx)
    for day in days:
        rows = tx.filter(F.col("load_date") == F.lit(day)).drop("load_date")
        for name, state in STATES.items():
            write_catalog(state(rows), cfg.database, name, cfg.target(name), partition={"load_date": day}, mode="overwrite")
    customers, by_product, buyers = (scan_catalog(spark, cfg.database, name) for name in STATES)
    if {"customer_id", "customers"} <= set(buyers.columns):
        raise ValueError(f"customer ids were whole numbers on some days only: remove {', '.join(STATES)} and run all days")
    names, _ = _names(spark, cfg, by_product, products, None)
    return {
        "customer_metrics": merged_customers(customers),
        "product_metrics": merged_products(by_product, buyers, names, whole_units=holds_whole(tx, "quantity")),
    }


def _days_without_state(spark: SparkSession, cfg: Config, tx: DataFrame) -> list[date]:
    """Load dates of the transactions that the last of the state tables lacks; a day is complete once it has that."""
    days = tx.select("load_date").distinct()
    last = list(STATES)[-1]
    if spark.catalog.tableExists(table_name(cfg.database, last)):
        held = spark.sql(f"SHOW PARTITIONS {table_name(cfg.database, last)}").collect()
        known = [date.fromisoformat(r["partition"].partition("=")[2]) for r in held]
        days = days.where(~F.col("load_date").isin(known)) if known else days
    return sorted(r["load_date"] for r in days.collect())


def _silver(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    """A silver table by its catalog name, which is first made to follow the table's current version.

    Where the catalog has lost a table that has no version, its files, with the columns found by name.
    """
    bind_table(spark, cfg.database, name, cfg.source(name), cfg.silver_format)
    if spark.catalog.tableExists(table_name(cfg.database, name)):
        return scan_catalog(spark, cfg.database, name)
    path, schema = cfg.source(name), None
    if cfg.silver_format in TEXT_FORMATS:
        schema = header_schema(spark, path, SILVER[name]) if cfg.silver_format == "csv" else SILVER[name]
    return scan_format(spark, path, cfg.silver_format, schema)


def run_reports(spark: SparkSession, cfg: Config) -> None:
    """Write the five reports as the day's snapshot under ``out_path``.

    Gold is read by name from the catalog; where that has lost the tables, or they are over another folder than
    ``in_path``, they are registered again. The five are published together (:func:`tillroll.sinks.publish_snapshots`):
    a report that fails leaves all five as they were.
    """
    create_report_tables(spark, cfg.reporting_database, cfg.target(""))
    for name, schema in GOLD.items():
        declared = schema if cfg.gold_format in TEXT_FORMATS else None
        register_table(spark, cfg.database, name, cfg.source(name), cfg.gold_format, declared)
    day = cfg.day(spark)
    cm = scan_catalog(spark, cfg.database, "customer_metrics")
    pm = scan_catalog(spark, cfg.database, "product_metrics")
    reports = {
        "customer_segment_value": customer_segment_value(cm),
        "customer_activity_analysis": customer_activity_analysis(cm, day),
        "category_performance_analysis": category_performance_analysis(pm),
        "top_performing_subcategories": top_performing_subcategories(pm),
        "customer_purchase_frequency": customer_purchase_frequency(cm),
    }
    publish_snapshots(spark, reports, cfg.reporting_database, cfg.target(""), day, cfg.mode)
