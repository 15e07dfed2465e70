"""The shape of the physical plans: what is read, how often it is shuffled, and what never occurs."""

import re

import pytest
from pyspark.sql import functions as F

from tillroll import plans
from tillroll.registry import QUERIES
from tillroll.registry import views as v

SF_DIR = "/root/testdata/sf0.001"
ON_FILES = {"scan_csv", "scan_format", "scan_catalog", "schema_drift", "sink_catalog_append", "sink_overwrite"}
ON_FILES |= {"sink_report_snapshot", "ddl_reports", "run_silver", "run_gold", "run_reports", "scan_csv_inferred"}
ON_FILES |= {"sink_catalog_type_change_lost", "run_gold_types_lost", "run_gold_as_of", "run_gold_incremental"}
ON_FILES |= {"scan_csv_one_pass", "run_silver_quarantine"}
ON_FILES |= {"sink_catalog_type_change", "run_gold_csv_silver", "run_gold_two_loads"}

pytestmark = pytest.mark.skipif(not __import__("os").path.isdir(SF_DIR), reason="no test tables")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"[-:] Exchange ", physical(df)))


def read_columns(df):
    """Names per scan, in plan order."""
    return [re.findall(r"(\w+):", schema) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", physical(df))]


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Silver tables with all their columns."""
    base = str(tmp_path_factory.mktemp("silver"))
    tx = v.tx_raw(spark, SF_DIR).withColumn("payment_method", F.lit("paypal"))
    plans.process_transactions(tx, v.AS_OF).write.parquet(f"{base}/tx")
    plans.process_products(v.products_raw(spark, SF_DIR), v.AS_OF).write.parquet(f"{base}/products")
    return spark.read.parquet(f"{base}/tx"), spark.read.parquet(f"{base}/products")


def test_customer_metrics_reads_five_columns_and_shuffles_once(silver):
    out = plans.customer_metrics(silver[0])
    assert read_columns(out) == [["transaction_id", "customer_id", "transaction_date", "quantity", "unit_price"]]
    assert shuffles(out) == 1


def test_product_metrics_broadcasts_a_small_dimension(silver):
    out = plans.product_metrics(*silver)
    assert read_columns(out)[:2] == [
        ["customer_id", "product_id", "quantity", "unit_price"],
        ["product_id", "category", "subcategory"],
    ]
    text = physical(out)
    assert "PushedFilters: [IsNotNull(product_id)]" in text
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    facts = text[: text.index("BroadcastExchange", text.index("BroadcastExchange") + 1)]
    assert facts.count(" Exchange ") == 2
    assert "hashpartitioning(_names_key" in text  # the pairs are shuffled by key, not by name


def test_product_metrics_shuffles_a_large_dimension(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in physical(plans.product_metrics(*silver))
        salted = physical(plans.product_metrics(*silver, salts=8))
        assert re.search(r"hashpartitioning\(product_id#\w+, _salt#\w+", salted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_report_that_needs_no_customers_does_not_count_them(silver):
    out = plans.top_performing_subcategories(plans.product_metrics(*silver))
    assert read_columns(out)[0] == ["product_id", "quantity", "unit_price"]


def test_shares_over_lazy_metrics_read_the_facts_once(silver):
    """Rows and totals begin with the same steps up to the first shuffle of the facts, which runs once."""
    out = plans.top_performing_subcategories(plans.product_metrics(*silver))
    out.collect()
    final = physical(out).partition("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet .*?quantity", final)) == 1 and "ReusedExchange" in final


def test_bitmaps_shuffle_no_customers(silver):
    text = physical(plans.product_metrics(*silver, bitmaps=True))
    assert "bitmap_construct_agg" in text and "Expand" not in text
    assert not re.search(r"hashpartitioning\([^)]*customer_id", text)


def test_top_n_needs_no_full_sort(silver):
    text = physical(plans.top_performing_subcategories(plans.product_metrics(*silver), 3))
    assert "TakeOrderedAndProject(limit=3" in text


def test_cleaning_shuffles_nothing(silver):
    out = plans.process_transactions(silver[0].drop("load_date"), v.AS_OF)
    assert shuffles(out) == 0
    assert "IsNotNull(quantity), IsNotNull(unit_price)" in physical(out)


@pytest.mark.parametrize("key", sorted(QUERIES.keys() - ON_FILES))
def test_no_python_no_cross_join_no_single_task(spark, key):
    text = physical(QUERIES[key](spark, SF_DIR))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    if key != "global_agg" and not key.startswith("customer_activity"):  # one row each, combined before it
        assert "SinglePartition" not in text
