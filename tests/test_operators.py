"""Cleaning, joining, windows and order on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll import operators as op
from tillroll.plans import product_metrics

NAN = float("nan")


def plan(df):
    return df._jdf.queryExecution().toString()


def test_drop_missing_one_column(spark):
    df = spark.createDataFrame([(1, None), (2, " "), (3, "a"), (4, "")], "id int, email string")
    assert rows(op.drop_missing(df, "email"), "id") == [(2, " "), (3, "a"), (4, "")]


def test_drop_missing_equals_na_drop(spark):
    values = [(1.0, 1), (NAN, 2), (None, 3), (4.0, None), (None, None)]
    df = spark.createDataFrame(values, "price double, supplier_id int")
    ours = rows(op.drop_missing(df, "price", "supplier_id"))
    assert ours == [(1.0, 1)]
    assert ours == rows(df.na.drop(subset=["price", "supplier_id"]))


def test_drop_missing_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1.0, 1)], "price double, supplier_id int").write.parquet(f"{tmp_path}/t")
    text = plan(op.drop_missing(spark.read.parquet(f"{tmp_path}/t"), "price", "supplier_id"))
    assert "IsNotNull(price)" in text and "IsNotNull(supplier_id)" in text


def test_normalize_and_load_date(spark):
    df = spark.createDataFrame([("A.B@X.Com", None), (None, "usa")], "email string, country string")
    out = op.add_load_date(op.normalize(df, {"email": F.lower, "country": F.upper}), date(2024, 4, 27))
    assert out.columns == ["email", "country", "load_date"]
    assert rows(out, F.col("email").asc_nulls_last()) == [
        ("a.b@x.com", None, date(2024, 4, 27)),
        (None, "USA", date(2024, 4, 27)),
    ]


@pytest.fixture
def tx(spark):
    values = [(1, 10, 2), (2, 10, 3), (3, 11, 1), (4, 99, 5), (5, None, 7)]
    return spark.createDataFrame(values, "transaction_id int, product_id int, quantity int")


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(10, "a"), (11, "b"), (12, "c"), (None, "d")], "product_id int, category string")


MATCHED = [(1, 10, 2, "a"), (2, 10, 3, "a"), (3, 11, 1, "b")]


@pytest.mark.parametrize("options", [{}, {"products_are_small": True}, {"salts": 2}, {"salts": 7}])
def test_join_drops_null_keys_and_orphans(tx, products, options):
    joined = op.join_tx_products(tx, products, **options)
    assert joined.columns.count("product_id") == 1 and "_salt" not in joined.columns
    assert rows(joined.select("transaction_id", "product_id", "quantity", "category"), "transaction_id") == MATCHED


def test_join_repeats_a_transaction_per_duplicate_product(spark, tx, products):
    twice = products.unionByName(products)
    assert op.join_tx_products(tx, twice).count() == 6
    assert op.join_tx_products(tx, twice, salts=4).count() == 6


def test_measured_bytes_grows_with_the_text(spark):
    small = spark.createDataFrame([(1, "a")], "id int, name string")
    large = spark.createDataFrame([(1, "a" * 1000)], "id int, name string")
    assert op.measured_bytes(large) - op.measured_bytes(small) == 999
    assert op.measured_bytes(small.limit(0)) == 0
    assert op.measured_bytes(spark.createDataFrame([(None,)], "name string")) > 0


@pytest.fixture
def shuffled(spark):
    """No broadcast, and small thresholds so that a test-sized hot key counts as skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    yield
    for k, value in before.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def hot_transactions(spark):
    """A third of 30,000 rows, and more, on product 7."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("int")
    return spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("transaction_id"), key.alias("product_id"), F.rand(1).alias("unit_price")
    )


def test_a_hot_product_is_split_by_adaptive_execution(spark, shuffled):
    products = spark.range(100).select(F.col("id").cast("int").alias("product_id"), F.lit("c").alias("category"))
    joined = op.join_tx_products(hot_transactions(spark), products)
    assert len(joined.collect()) == 30_000
    assert "isSkew=true" in plan(joined) or "skew=true" in plan(joined)


def test_a_hot_product_is_split_under_the_metrics_too(spark, shuffled):
    products = spark.range(100).select(
        F.col("id").cast("int").alias("product_id"), F.lit("c").alias("category"), F.lit("s").alias("subcategory")
    )
    tx = hot_transactions(spark).withColumns({"customer_id": F.col("transaction_id") % 50, "quantity": F.lit(1)})
    out = product_metrics(tx, products)
    assert out.first()["total_units_sold"] == 30_000
    out.collect()
    assert "isSkew=true" in plan(out) or "skew=true" in plan(out)


def test_salting_spreads_a_hot_product(spark, shuffled):
    products = spark.range(100).select(F.col("id").cast("int").alias("product_id"), F.lit("c").alias("category"))

    def largest_share(joined):
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        return max(sizes) / sum(sizes)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = largest_share(op.join_tx_products(hot_transactions(spark), products))
        salted = largest_share(op.join_tx_products(hot_transactions(spark), products, salts=16))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plain > 0.33 and salted < 0.25


def test_only_hot_products_are_repeated(spark, shuffled):
    products = spark.range(1000).select(F.col("id").cast("int").alias("product_id"), F.lit("c").alias("category"))
    tx = hot_transactions(spark)
    hot = op.hot_products(tx)
    assert hot and len(hot) < 100
    shares = {r["product_id"]: r["count"] / tx.count() for r in tx.groupBy("product_id").count().collect()}
    assert hot == sorted(k for k, share in shares.items() if share > 0.01 and k is not None)
    joined = op.join_tx_products(tx, products, salts=16)
    assert joined.count() == tx.where("product_id < 1000").count()
    assert op.hot_products(tx, hot_share=0.9) == []


def test_totals_bring_no_partition_together(spark):
    df = spark.createDataFrame([("a", 0.1)] * 10, "category string, revenue double")
    total = op.partition_total(df, "revenue", ["category"], "total")
    assert rows(total.select("total").distinct()) == [(1.0,)]
    assert "Window" not in total._jdf.queryExecution().executedPlan().toString()


def test_partition_total_and_share(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("b", 0.0), ("c", None), (None, 5.0)], "category string, revenue double"
    )
    total = op.partition_total(df, "revenue", ["category"], "total")
    assert rows(total.select("category", "revenue", "total"), F.col("category").asc_nulls_last(), "revenue") == [
        ("a", 1.0, 3.0),
        ("a", 2.0, 3.0),
        ("b", 0.0, 0.0),
        ("c", None, None),
        (None, 5.0, 5.0),
    ]
    share = op.partition_share(df, "revenue", ["category"], "share")
    assert rows(share.select("category", "share"), F.col("category").asc_nulls_last(), "share") == [
        ("a", 33.33),
        ("a", 66.67),
        ("b", None),
        ("c", None),
        (None, 100.0),
    ]


def test_order_desc_puts_nulls_first(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (2.0,)], "x double")
    assert rows(op.order_desc(df, "x")) == [(None,), (3.0,), (2.0,), (1.0,)]
    assert rows(op.order_desc(df, "x", 2)) == [(None,), (3.0,)]


def test_order_desc_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([("b", 1.0, 2), ("a", 1.0, 2), ("a", 1.0, 1), ("z", 2.0, 9)], "k string, x double, n int")
    expected = [("z", 2.0, 9), ("a", 1.0, 1), ("a", 1.0, 2), ("b", 1.0, 2)]
    assert rows(op.order_desc(df.repartition(4), "x")) == expected
    assert rows(op.order_desc(df.repartition(3, "n"), "x", 2)) == expected[:2]
