"""Raw to silver: the three cleaning rules."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.cleaning import add_load_date, drop_missing, normalize

#: What a row of each table must have to be kept.
REQUIRED = {"customers": ["email"], "products": ["price", "supplier_id"], "transactions": ["quantity", "unit_price"]}


def process_customers(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Drop customers without email, lower-case the email, upper-case the country, add the load date."""
    kept = drop_missing(df, *REQUIRED["customers"])
    return add_load_date(normalize(kept, {"email": F.lower, "country": F.upper}), as_of)


def process_products(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Drop products without price or supplier, init-cap category and subcategory, add the load date."""
    kept = drop_missing(df, *REQUIRED["products"])
    return add_load_date(normalize(kept, {"category": F.initcap, "subcategory": F.initcap}), as_of)


def process_transactions(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Drop transactions without quantity or unit price, add the load date."""
    return add_load_date(drop_missing(df, *REQUIRED["transactions"]), as_of)
