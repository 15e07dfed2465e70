"""Cleaning rules, metrics and reports: edge rows, golden figures and properties."""

import math
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll import plans
from tillroll.plans import gold
from tillroll.sources.schemas import GOLD

DAY = date(2024, 4, 27)
NAN = float("nan")
TX = "transaction_id int, customer_id int, product_id int, transaction_date timestamp, quantity int, unit_price double"
PRODUCTS = "product_id int, product_name string, category string, subcategory string, price double, supplier_id int"


def at(text):
    return datetime.fromisoformat(text)


# The nine products and transactions of the sample files that the tests need: all books, and one bare quote.
SAMPLE_PRODUCTS = [
    (103, 'Smart 4K TV 55"', "Electronics", "TVs", 799.99, 503),
    (108, "Bestseller Fiction Novel", "Books", "Fiction", 19.99, 508),
    (116, "Fantasy Book Collection", "Books", "Fiction", 49.99, 516),
    (122, "Cookbook Collection", "Books", "Non-Fiction", 39.99, 502),
    (130, "Mystery Novel Series", "Books", "Fiction", 29.99, 510),
    (134, "Children's Picture Book", "Books", "Children", 14.99, 514),
    (139, "Comic Book Collection", "Books", "Comics", 44.99, 519),
    (144, "Science Textbook", "Books", "Educational", 79.99, 504),
    (149, "Self-Help Book", "Books", "Non-Fiction", 24.99, 509),
]
SAMPLE_TRANSACTIONS = [
    (1001, 15, 103, at("2024-01-15 10:30:00"), 1, 799.99),
    (1003, 23, 108, at("2024-01-15 13:20:00"), 3, 19.99),
    (1013, 13, 116, at("2024-01-17 11:45:00"), 2, 49.99),
    (1024, 37, 130, at("2024-01-19 13:25:00"), 2, 29.99),
    (1029, 49, 144, at("2024-01-20 13:30:00"), 2, 79.99),
    (1039, 1, 149, at("2024-01-22 13:25:00"), 1, 24.99),
    (1040, 26, 134, at("2024-01-22 14:40:00"), 2, 14.99),
    (1041, 43, 139, at("2024-01-23 09:20:00"), 1, 44.99),
    (1046, 2, 122, at("2024-01-24 09:25:00"), 1, 39.99),
]

# Golden product metrics of the whole sample: revenue, units, mean price (4 decimals), customers, share in percent.
GOLDEN = [
    ("Electronics", "Computers", 1599.98, 2, 799.99, 2, 32.26),
    ("Electronics", "Tvs", 799.99, 1, 799.99, 1, 16.13),
    ("Electronics", "Audio", 569.96, 4, 166.6567, 3, 11.49),
    ("Electronics", "Gaming", 499.99, 1, 499.99, 1, 10.08),
    ("Electronics", "Accessories", 449.91, 9, 54.99, 4, 9.07),
    ("Sports", "Equipment", 440.92, 8, 71.19, 5, 52.75),
    ("Electronics", "Cameras", 399.99, 1, 399.99, 1, 8.06),
    ("Electronics", "Wearables", 379.98, 2, 189.99, 2, 7.66),
    ("Home & Garden", "Kitchen", 309.98, 2, 154.99, 2, 20.20),
    ("Electronics", "Security", 259.98, 2, 129.99, 1, 5.24),
    ("Clothing", "Outerwear", 239.98, 2, 119.99, 2, 41.38),
    ("Books", "Fiction", 219.93, 7, 33.3233, 3, 42.31),
    ("Home & Garden", "Appliances", 199.99, 1, 199.99, 1, 13.03),
    ("Home & Garden", "Furniture", 199.99, 1, 199.99, 1, 13.03),
    ("Home & Garden", "Lighting", 199.95, 5, 39.99, 2, 13.03),
    ("Home & Garden", "Smart Home", 179.99, 1, 179.99, 1, 11.73),
    ("Sports", "Nutrition", 164.97, 3, 54.99, 1, 19.74),
    ("Books", "Educational", 159.98, 2, 79.99, 1, 30.77),
    ("Home & Garden", "Bedding", 139.98, 2, 69.99, 1, 9.12),
    ("Home & Garden", "Decor", 119.97, 3, 39.99, 1, 7.82),
    ("Clothing", "Shirts", 109.97, 3, 42.49, 2, 18.96),
    ("Home & Garden", "Bath", 104.97, 3, 34.99, 1, 6.84),
    ("Clothing", "Pants", 89.99, 1, 89.99, 1, 15.52),
    ("Sports", "Footwear", 89.99, 1, 89.99, 1, 10.77),
    ("Clothing", "Athletic Wear", 89.98, 2, 44.99, 1, 15.52),
    ("Home & Garden", "Garden", 79.99, 1, 79.99, 1, 5.21),
    ("Sports", "Accessories", 79.96, 4, 19.99, 1, 9.57),
    ("Books", "Non-fiction", 64.98, 2, 32.49, 2, 12.50),
    ("Sports", "Apparel", 59.98, 2, 29.99, 1, 7.18),
    ("Clothing", "Accessories", 49.99, 1, 49.99, 1, 8.62),
    ("Books", "Comics", 44.99, 1, 44.99, 1, 8.65),
    ("Books", "Children", 29.98, 2, 14.99, 1, 5.77),
]


def cm_rows(spark, values):
    return spark.createDataFrame(values, GOLD["customer_metrics"])


def pm_rows(spark, values):
    return spark.createDataFrame(values, GOLD["product_metrics"])


@pytest.fixture(scope="module")
def golden_pm(spark):
    return pm_rows(spark, [(c, s, units, revenue, price, n) for c, s, revenue, units, price, n, _ in GOLDEN])


# Cleaning


def test_process_customers(spark):
    df = spark.createDataFrame(
        [(1, None, "usa"), (2, " ", None), (3, "A.B@X.Com", "Uk")], "customer_id int, email string, country string"
    )
    assert rows(plans.process_customers(df, DAY), "customer_id") == [(2, " ", None, DAY), (3, "a.b@x.com", "UK", DAY)]


def test_process_products(spark):
    df = spark.createDataFrame(
        [
            (1, "p", "home & garden", "TVs", 1.5, 7),
            (2, "p", "Books", "Non-Fiction", 2.5, 7),
            (3, "p", "x", "x", None, 7),
            (4, "p", "x", "x", NAN, 7),
            (5, "p", "x", "x", 1.0, None),
        ],
        PRODUCTS,
    )
    assert rows(plans.process_products(df, DAY), "product_id") == [
        (1, "p", "Home & Garden", "Tvs", 1.5, 7, DAY),
        (2, "p", "Books", "Non-fiction", 2.5, 7, DAY),
    ]


def test_process_transactions(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0), (2, 1, NAN), (3, 1, None), (4, 0, 2.0), (5, -3, 2.0)],
        "transaction_id int, quantity int, unit_price double",
    )
    assert rows(plans.process_transactions(df, DAY), "transaction_id") == [(4, 0, 2.0, DAY), (5, -3, 2.0, DAY)]


def test_load_date_is_today_by_default(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "transaction_id int, quantity int, unit_price double")
    out = plans.process_transactions(df)
    assert out.filter(F.col("load_date") == F.current_date()).count() == 1


# Metrics


def test_customer_metrics_edges(spark):
    tx = spark.createDataFrame(
        [
            (1, 7, 1, at("2024-01-02 00:00:00"), 2, 10.0),
            (None, 7, 1, at("2024-01-01 00:00:00"), 1, 5.0),
            (3, None, 1, at("2024-01-05 00:00:00"), 1, 1.0),
            (4, None, 1, None, None, 9.0),
            (5, 8, 1, None, None, None),
        ],
        TX,
    )
    out = plans.customer_metrics(tx)
    assert [(f.name, f.dataType) for f in out.schema][1:] == [(f.name, f.dataType) for f in GOLD["customer_metrics"]][1:]
    assert rows(out, F.col("customer_id").asc_nulls_last()) == [
        (7, 1, 25.0, 12.5, at("2024-01-01"), at("2024-01-02")),
        (8, 1, None, None, None, None),
        (None, 2, 1.0, 1.0, at("2024-01-05"), at("2024-01-05")),
    ]


def test_product_metrics_edges(spark):
    tx = spark.createDataFrame(
        [
            (1, 7, 1, None, 2, 10.0),
            (2, 7, 2, None, 1, 5.0),  # the same customer in another subcategory
            (3, 7, 1, None, 1, 20.0),
            (4, None, 1, None, 1, 30.0),  # no customer: summed but not counted
            (5, 9, 99, None, 1, 1.0),  # no such product
            (6, 9, None, None, 1, 1.0),
        ],
        TX,
    )
    products = spark.createDataFrame(
        [(1, "p", "a", "x", 999.0, 1), (2, "p", "a", "y", 999.0, 1), (3, "p", "a", "z", 999.0, 1)], PRODUCTS
    )
    expected = [("a", "x", 4, 70.0, 20.0, 1), ("a", "y", 1, 5.0, 5.0, 1)]
    for options in ({}, {"products_are_small": True}, {"salts": 4}, {"distinct_rsd": 0.05}):
        out = plans.product_metrics(tx, products, **options)
        assert rows(out, "subcategory") == expected, options
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in GOLD["product_metrics"]]


def test_fractional_quantities_count_in_full(spark):
    tx = spark.createDataFrame(
        [(1, 7, 1, datetime(2024, 1, 1), 1.5, 10.0), (2, 7, 1, datetime(2024, 1, 2), 0.5, 4.0), (3, 8, 2, datetime(2024, 1, 2), 2.0, 0.25)],
        "transaction_id int, customer_id int, product_id int, transaction_date timestamp, quantity double, unit_price double",
    )
    products = spark.createDataFrame([(1, "a", "b"), (2, "a", "c")], "product_id int, category string, subcategory string")
    cm, pm = plans.customer_metrics(tx), plans.product_metrics(tx, products)
    assert rows(cm.select("customer_id", "total_spent", "avg_transaction_amount"), "customer_id") == [(7, 17.0, 8.5), (8, 0.5, 0.5)]
    assert rows(pm.select("subcategory", "total_units_sold", "total_revenue"), "subcategory") == [("b", 2.0, 17.0), ("c", 2.0, 0.5)]
    category = plans.category_performance_analysis(pm)
    assert rows(category.select("category_revenue", "category_units")) == [(17.5, 4.0)]


def test_missing_names_form_their_own_groups(spark):
    names = [("x", None), (None, "x"), (None, None), ("", ""), ("ab", "c"), ("a", "bc")]
    products = spark.createDataFrame([(i, "p", c, s, 1.0, 1) for i, (c, s) in enumerate(names)], PRODUCTS)
    tx = spark.createDataFrame([(i, 7, i, None, i + 1, 1.0) for i in range(len(names))], TX)
    out = {(r["category"], r["subcategory"]): r["total_units_sold"] for r in plans.product_metrics(tx, products).collect()}
    assert out == {pair: i + 1 for i, pair in enumerate(names)}


def test_names_are_looked_up_with_one_shuffle_and_no_check(spark):
    products = spark.createDataFrame([(1, "p", "a", "x", 1.0, 1), (2, "p", "a", "y", 1.0, 1)], PRODUCTS)
    text = gold._names_by_key(products)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text and "raise_error" not in text


def test_both_sides_may_carry_a_load_date(spark):
    tx = plans.process_transactions(spark.createDataFrame(SAMPLE_TRANSACTIONS, TX), DAY)
    products = plans.process_products(spark.createDataFrame(SAMPLE_PRODUCTS, PRODUCTS), DAY)
    out = rows(plans.product_metrics(tx, products).filter("category = 'Books'"), "subcategory")
    golden = sorted((s, units, revenue, price, n) for c, s, revenue, units, price, n, _ in GOLDEN if c == "Books")
    assert [(s, units, revenue, round(price, 4), n) for _, s, units, revenue, price, n in out] == golden


def test_metrics_do_not_depend_on_partitioning(spark):
    tx = spark.range(5000).select(
        F.col("id").alias("transaction_id"),
        (F.col("id") % 13).alias("customer_id"),
        (F.col("id") % 5).alias("product_id"),
        F.timestamp_seconds(F.col("id") * 977).alias("transaction_date"),
        (F.col("id") % 4 + 1).cast("int").alias("quantity"),
        (F.col("id") * 37 % 10007 / 100).alias("unit_price"),
    )
    products = spark.range(4).select(F.col("id").alias("product_id"), F.lit("c").alias("category"), F.lit("s").alias("subcategory"))
    one, many = tx.coalesce(1), tx.repartition(9, "unit_price")
    assert rows(plans.customer_metrics(one), "customer_id") == rows(plans.customer_metrics(many), "customer_id")
    assert rows(plans.product_metrics(one, products)) == rows(plans.product_metrics(many, products))


def test_report_sums_do_not_depend_on_partitioning(spark):
    money = (F.col("id") * 7919 % 1_000_003 * 1_000_003 / 100).alias("total_spent")
    cm = spark.range(20_000).select(
        F.col("id").alias("customer_id"), (F.col("id") % 9).alias("total_transactions"), money, F.lit(1.0).alias("avg_transaction_amount")
    )
    pm = spark.range(20_000).select(
        (F.col("id") % 3).cast("string").alias("category"),
        F.col("id").alias("total_units_sold"),
        money.alias("total_revenue"),
        F.lit(1.0).alias("avg_price"),
        F.lit(1).alias("unique_customers"),
    )
    for report, gold_rows in (
        (plans.customer_segment_value, cm),
        (plans.customer_purchase_frequency, cm),
        (plans.category_performance_analysis, pm),
    ):
        one, many = report(gold_rows.coalesce(1)), report(gold_rows.repartition(7))
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.none() | st.integers(1, 4),
            st.none() | st.integers(1, 5),
            st.none() | st.integers(-3, 9),
            st.none() | st.integers(0, 10**7).map(lambda cents: cents / 100),
        ),
        max_size=30,
    )
)
def test_gold_adds_up(spark, values):
    tx = spark.createDataFrame([(i, c, p, None, q, x) for i, (c, p, q, x) in enumerate(values)], TX)
    products = spark.createDataFrame([(p, "p", f"c{p % 2}", f"s{p}", 1.0, 1) for p in (1, 2, 3)], PRODUCTS)
    cm, pm = plans.customer_metrics(tx).collect(), plans.product_metrics(tx, products).collect()
    assert sum(r["total_transactions"] for r in cm) == len(values)
    lines = [q * round(x * 100) for _, _, q, x in values if q is not None and x is not None]
    assert sum(round((r["total_spent"] or 0) * 100) for r in cm) == sum(lines)
    sold = [q * round(x * 100) for _, p, q, x in values if p in (1, 2, 3) and q is not None and x is not None]
    assert sum(round((r["total_revenue"] or 0) * 100) for r in pm) == sum(sold)
    customers = {(p, c) for c, p, _, _ in values if p in (1, 2, 3) and c is not None}
    assert sum(r["unique_customers"] for r in pm) == len(customers)


# Reports


def test_segment_value_edges(spark):
    cm = cm_rows(spark, [(i, n, spent, None, None, None) for i, (n, spent) in enumerate([(1, 499.99), (2, 500.0), (2, 999.99), (7, 1000.0), (None, None)])])
    out = plans.customer_segment_value(cm)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("customer_segment", "string"),
        ("customer_count", "bigint"),
        ("avg_spent", "double"),
        ("avg_transactions", "bigint"),
    ]
    assert rows(out) == [("High Value", 1, 1000.0, 7), ("Medium Value", 2, 749.995, 2), ("Low Value", 2, 499.99, 1)]


def test_segment_value_truncates_the_mean_count(spark):
    cm = cm_rows(spark, [(i, n, 1.0, 1.0, None, None) for i, n in enumerate([1, 2, 2])])
    assert rows(plans.customer_segment_value(cm)) == [("Low Value", 3, 1.0, 1)]


def test_activity_edges(spark):
    cm = cm_rows(
        spark,
        [
            (1, 1, 1.0, 1.0, at("2024-01-28 10:00:00"), at("2024-01-28 23:59:59")),  # 90 days before
            (2, 1, 1.0, 1.0, at("2024-01-26 23:00:00"), at("2024-01-27 01:00:00")),  # 91 days, lifespan 1
            (3, 1, 1.0, 1.0, None, None),
        ],
    )
    assert rows(plans.customer_activity_analysis(cm, DAY)) == [(3, 1, 1, 0)]
    assert rows(plans.customer_activity_analysis(cm.filter("customer_id = 2"), DAY)) == [(1, 0, 1, 1)]
    assert rows(plans.customer_activity_analysis(cm, DAY, days=91)) == [(3, 2, 0, 0)]


def test_activity_of_nobody(spark):
    assert rows(plans.customer_activity_analysis(cm_rows(spark, []), DAY)) == [(0, 0, 0, None)]


def test_activity_reads_epoch_micros(spark):
    cm = cm_rows(spark, [(1, 1, 1.0, 1.0, at("2024-01-26 23:00:00"), at("2024-01-28 01:00:00"))])
    micros = cm.withColumns({c: F.unix_micros(c) for c in ("first_purchase", "last_purchase")})
    assert micros.schema["last_purchase"].dataType.simpleString() == "bigint"
    assert rows(plans.customer_activity_analysis(micros, DAY)) == rows(plans.customer_activity_analysis(cm, DAY)) == [(1, 1, 0, 2)]


def test_category_performance_keeps_its_semantics(spark):
    pm = pm_rows(
        spark,
        [("a", "x", 100, 1000.0, 10.0, 4), ("a", "y", 1, 30.0, 30.0, 4), ("b", "z", 2, 5.0, 2.5, 0)],
    )
    assert rows(plans.category_performance_analysis(pm)) == [
        ("a", 1030.0, 101, 8, 20.0, 128.75),  # customers summed, mean of means
        ("b", 5.0, 2, 0, 2.5, None),
    ]


def test_category_performance_golden(golden_pm):
    out = [(c, round(r, 2), u, n, round(p, 4), round(v, 4)) for c, r, u, n, p, v in rows(plans.category_performance_analysis(golden_pm))]
    assert out == [
        ("Electronics", 4959.78, 22, 15, 380.1983, 330.6520),
        ("Home & Garden", 1534.81, 19, 11, 111.1011, 139.5282),
        ("Sports", 835.82, 18, 9, 53.2300, 92.8689),
        ("Clothing", 579.91, 9, 7, 69.4900, 82.8443),
        ("Books", 519.86, 14, 8, 41.1567, 64.9825),
    ]


def test_top_subcategories_golden(golden_pm):
    out = rows(plans.top_performing_subcategories(golden_pm))
    assert sorted(out) == sorted((c, s, revenue, units, share) for c, s, revenue, units, _, _, share in GOLDEN)
    assert [r[2] for r in out] == sorted((r[2] for r in out), reverse=True)
    by_category = {}
    for category, _, _, _, share in out:
        by_category[category] = by_category.get(category, 0) + share
    assert all(math.isclose(total, 100, abs_tol=0.05) for total in by_category.values())


def test_top_subcategories_limit_and_zero_revenue(spark, golden_pm):
    assert [r[:2] for r in rows(plans.top_performing_subcategories(golden_pm, 2))] == [
        ("Electronics", "Computers"),
        ("Electronics", "Tvs"),
    ]
    pm = pm_rows(spark, [("a", "x", 1, 0.0, 0.0, 1), ("b", "y", 1, 2.0, 2.0, 1)])
    assert rows(plans.top_performing_subcategories(pm)) == [("b", "y", 2.0, 1, 100.0), ("a", "x", 0.0, 1, None)]


def test_purchase_frequency_edges(spark):
    cm = cm_rows(spark, [(i, n, 10.0 * i, 1.0 * i, None, None) for i, n in enumerate([4, 5, 9, 10, None])])
    assert rows(plans.customer_purchase_frequency(cm), "customer_count", "frequency_segment") == [
        ("Frequent (10+ transactions)", 1, 30.0, 3.0),
        ("Occasional (1-4 transactions)", 2, 20.0, 2.0),
        ("Regular (5-9 transactions)", 2, 15.0, 1.5),
    ]


def test_segments_add_up_to_the_customers(spark):
    cm = cm_rows(spark, [(i, i % 14, float(i * 31 % 1500), 1.0, None, None) for i in range(200)])
    assert sum(r["customer_count"] for r in plans.customer_segment_value(cm).collect()) == 200
    assert sum(r["customer_count"] for r in plans.customer_purchase_frequency(cm).collect()) == 200
