"""As-of names, bitmaps, and gold from daily states."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_jobs import CM, DAY, NEXT, PM, PRODUCTS, TRANSACTIONS, cfg, gold, read_gold  # noqa: F401
from tillroll import plans
from tillroll.operators import names_as_of, newest_names, newest_rows
from tillroll.plans import run_gold, run_silver, states

DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(6)]
NAMED = "product_id int, load_date date, category string, subcategory string"


def as_of_by_hand(keys, loads, stands_in):
    out = []
    for product, day in sorted({k for k in keys if None not in k}):
        mine = [(d, (c, s)) for p, d, c, s in loads if p == product and d is not None]
        before = [x for x in mine if x[0] <= day]
        load = max((d for d, _ in before), default=min((d for d, _ in mine), default=None) if stands_in else None)
        if load is not None:
            out.append((product, day, *max((n for d, n in mine if d == load), key=lambda n: [(x is not None, x or "") for x in n])))
    return out


@pytest.mark.parametrize("stands_in", [True, False])
def test_names_as_of_by_hand(spark, stands_in):
    rng = random.Random(6)
    loads = [(rng.randrange(9), rng.choice(DAYS), rng.choice(("a", "b", None)), rng.choice("xyz")) for _ in range(40)]
    loads += [(None, DAYS[0], "n", "n"), (3, None, "n", "n")]
    keys = [(rng.randrange(12), rng.choice(DAYS)) for _ in range(300)] + [(None, DAYS[0]), (3, None)]
    out = names_as_of(spark.createDataFrame(keys, "product_id int, load_date date"), spark.createDataFrame(loads, NAMED), first_stands_in=stands_in)
    assert rows(out, "product_id", "load_date") == as_of_by_hand(keys, loads, stands_in)
    assert names_as_of(spark.createDataFrame([], "product_id int, load_date date"), spark.createDataFrame(loads, NAMED)).count() == 0


def test_newest_names_and_rows(spark):
    loads = [(1, DAYS[0], "a", "x"), (1, DAYS[1], "a", "y"), (1, DAYS[1], "a", "z"), (2, DAYS[0], "b", "x"), (None, DAYS[0], "c", "x")]
    df = spark.createDataFrame(loads, NAMED)
    assert rows(newest_names(df).where("product_id IS NOT NULL"), "product_id") == [(1, "a", "z"), (2, "b", "x")]
    assert sorted(rows(newest_rows(df)), key=str) == sorted([*loads[1:4], loads[4]], key=str)


TX = "transaction_id int, customer_id {}, product_id int, transaction_date timestamp, quantity {}, unit_price double, load_date date"


def many(spark, customer="int", quantity="int"):
    rng, out = random.Random(8), []
    ids = {"int": lambda: rng.choice((None, -5, 0, 1, 32768, 32769, 70_000, rng.randrange(200))), "string": lambda: f"c{rng.randrange(50)}"}
    for i in range(1500):
        q = rng.choice((None, 1, 2, 7)) if quantity == "int" else rng.choice((None, 0.25, 1.5, 3.0))
        price = rng.choice((None, 0.1, 19.99, 1.2345, 7.0))
        product = rng.choice((1, 1, 1, 2, 3, 4, 99, None))
        out.append((i, ids[customer](), product, datetime(2024, 1, 1) + timedelta(hours=rng.randrange(500)), q, price, rng.choice(DAYS)))
    return spark.createDataFrame(out, TX.format(customer, quantity)).repartition(7)


NAMES = [(1, "a", "x"), (2, "a", "x"), (3, "a", None), (4, None, "x")]


def names(spark):
    return spark.createDataFrame(NAMES, "product_id int, category string, subcategory string")


@pytest.mark.parametrize("quantity", ["int", "double"])
@pytest.mark.parametrize("customer", ["int", "string"])
def test_states_add_up_to_gold(spark, customer, quantity):
    tx, products = many(spark, customer, quantity), names(spark)
    days = [tx.where(F.col("load_date") == d).drop("load_date") for d in DAYS]

    def union(state):
        parts = [state(day) for day in days]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    cm = states.merged_customers(union(states.customer_state))
    assert sorted(rows(cm), key=str) == sorted(rows(plans.customer_metrics(tx)), key=str)
    pm = states.merged_products(
        union(states.product_state), union(states.product_customers), products, whole_units=quantity == "int"
    )
    want = plans.product_metrics(tx, products)
    assert sorted(rows(pm), key=str) == sorted(rows(want), key=str)
    assert pm.schema["total_units_sold"].dataType == want.schema["total_units_sold"].dataType


@pytest.mark.parametrize("quantity", ["int", "double"])
def test_bitmaps_count_as_pairs_do(spark, quantity):
    tx, products = many(spark, "int", quantity), names(spark)
    pairs, bitmaps = (plans.product_metrics(tx, products, bitmaps=b) for b in (False, True))
    assert sorted(rows(bitmaps), key=str) == sorted(rows(pairs), key=str)
    assert [(f.name, f.dataType) for f in bitmaps.schema] == [(f.name, f.dataType) for f in pairs.schema]


def test_bitmaps_of_large_and_negative_ids(spark):
    ids = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2**40, 2**40 + 1, -(2**40), 0, 1, 2**62]
    tx = spark.createDataFrame([(i, c, 1, datetime(2024, 1, 1), 1, 1.0, DAYS[0]) for i, c in enumerate(ids)], TX.format("bigint", "int"))
    out = plans.product_metrics(tx, names(spark), bitmaps=True).first()
    assert out["unique_customers"] == len(set(ids))


def test_bitmaps_refuse_other_ids(spark):
    with pytest.raises(ValueError, match="whole numbers"):
        plans.product_metrics(many(spark, "string"), names(spark), bitmaps=True)


def raw_file(cfg, name, text):  # noqa: F811
    (Path(cfg().base_uri) / "raw" / f"{name}.csv").write_text(text)


RENAMED = PRODUCTS.splitlines()[0] + "\n2,Novel,books,classics,10.00,6\n5,Pen,office,pens,5.00,6\n"
MORE = TRANSACTIONS.splitlines()[0] + "\n6,2,2,2024-04-17 10:30:00,1,5.00,paypal\n7,2,5,2024-04-17 10:30:00,2,1.50,paypal\n"


@pytest.fixture
def two_loads(spark, cfg):  # noqa: F811
    """Product 2 is renamed by the second load, which lacks product 1 and has a new one."""
    run_silver(spark, cfg())
    raw_file(cfg, "transactions", MORE)
    raw_file(cfg, "products", RENAMED)
    run_silver(spark, cfg(as_of=NEXT))
    return cfg


def by_names(spark, config):
    return {(r[0], r[1]): r[3] for r in read_gold(spark, config)[1]}


@pytest.mark.parametrize("limit", [10**6, 10])
def test_products_as_of_their_load(spark, two_loads, limit):
    cfg = two_loads  # noqa: F811
    run_gold(spark, gold(cfg, product_rows="as_of", broadcast_limit_bytes=limit, product_salts=4))
    want = {("Books", "Fiction"): 40.96, ("Books", "Classics"): 5.0, ("Electronics", "Tvs"): 799.99, ("Office", "Pens"): 3.0}
    assert by_names(spark, cfg()) == want
    run_gold(spark, gold(cfg, broadcast_limit_bytes=limit))
    newest = {("Books", "Classics"): 45.96, ("Electronics", "Tvs"): 799.99, ("Office", "Pens"): 3.0}
    assert by_names(spark, cfg()) == newest


@pytest.mark.parametrize("product_rows", ["newest", "as_of"])
def test_a_day_takes_no_names_of_later_loads(spark, two_loads, product_rows):
    cfg = two_loads  # noqa: F811
    run_gold(spark, gold(cfg, load_date=DAY, product_rows=product_rows))
    assert read_gold(spark, cfg()) == (CM, PM)
    run_gold(spark, gold(cfg, load_date=NEXT, product_rows=product_rows))
    assert by_names(spark, cfg()) == {("Books", "Classics"): 5.0, ("Office", "Pens"): 3.0}


def test_a_product_that_only_later_loads_know_counts(spark, cfg):  # noqa: F811
    raw_file(cfg, "products", PRODUCTS.splitlines()[0] + "\n1,Wall screen,electronics,TVs,800.00,5\n")
    run_silver(spark, cfg())
    raw_file(cfg, "transactions", TRANSACTIONS.splitlines()[0] + "\n")
    raw_file(cfg, "products", PRODUCTS)
    run_silver(spark, cfg(as_of=NEXT))
    for options in ({"product_rows": "as_of"}, {"load_date": DAY}, {}):
        run_gold(spark, gold(cfg, **options))
        assert read_gold(spark, cfg())[1] == PM


def test_every_row_of_the_newest_load(spark, cfg):  # noqa: F811
    raw_file(cfg, "products", PRODUCTS + "2,Novel,books,gifts,11.00,6\n")
    run_silver(spark, cfg())
    raw_file(cfg, "transactions", TRANSACTIONS.splitlines()[0] + "\n")
    run_silver(spark, cfg(as_of=NEXT))
    both = {("Books", "Fiction"): 40.96, ("Books", "Gifts"): 40.96, ("Electronics", "Tvs"): 799.99}
    run_gold(spark, gold(cfg, product_rows="newest_rows"))
    assert by_names(spark, cfg()) == both
    run_gold(spark, gold(cfg))
    assert by_names(spark, cfg()) == {k: both[k] for k in (("Books", "Gifts"), ("Electronics", "Tvs"))}
    run_gold(spark, gold(cfg, product_rows="all"))
    assert by_names(spark, cfg()) == {k: 2 * v for k, v in both.items()}
    with pytest.raises(ValueError, match="product_rows"):
        run_gold(spark, gold(cfg, product_rows="some"))


@pytest.mark.parametrize("product_rows", ["newest", "as_of"])
def test_states_of_days_and_a_rerun(spark, two_loads, product_rows):
    cfg = two_loads  # noqa: F811
    steps = gold(cfg, incremental=True, product_rows=product_rows)
    run_gold(spark, steps)
    from_states = read_gold(spark, cfg())
    run_gold(spark, gold(cfg, product_rows=product_rows))
    assert from_states == read_gold(spark, cfg())

    # the first day comes again without its last row, and only its state is made anew
    raw_file(cfg, "transactions", "\n".join(TRANSACTIONS.splitlines()[:3]) + "\n")
    raw_file(cfg, "products", PRODUCTS)
    run_silver(spark, cfg())
    run_gold(spark, steps)  # has a state of every day: reads no transactions
    assert read_gold(spark, cfg()) == from_states
    spark.sql(f"ALTER TABLE {cfg().database}.transactions DROP PARTITION (load_date = DATE'{NEXT}')")  # can't be read any more
    run_gold(spark, gold(cfg, incremental=True, product_rows=product_rows, load_date=DAY))
    again = read_gold(spark, cfg())
    spark.sql(f"MSCK REPAIR TABLE {cfg().database}.transactions")
    run_gold(spark, gold(cfg, product_rows=product_rows))
    assert again == read_gold(spark, cfg()) != from_states


def test_states_survive_a_lost_catalog(spark, two_loads):
    cfg = two_loads  # noqa: F811
    run_gold(spark, gold(cfg, incremental=True, load_date=DAY))
    for table in spark.catalog.listTables(cfg().database):
        spark.sql(f"DROP TABLE {cfg().database}.{table.name}")
    run_gold(spark, gold(cfg, incremental=True))
    from_states = read_gold(spark, cfg())
    run_gold(spark, gold(cfg))
    assert from_states == read_gold(spark, cfg())
