"""DataFrame-to-DataFrame operators, usable alone or with ``df.transform``."""

from tillroll.operators.asof import names_as_of, newest_names, newest_rows
from tillroll.operators.cleaning import add_load_date, all_present, drop_missing, normalize
from tillroll.operators.joins import BROADCAST_LIMIT_BYTES, HOT_SHARE, hot_products, join_tx_products, measured_bytes
from tillroll.operators.ordering import order_desc
from tillroll.operators.windows import partition_share, partition_total

__all__ = [
    "BROADCAST_LIMIT_BYTES",
    "HOT_SHARE",
    "add_load_date",
    "all_present",
    "drop_missing",
    "hot_products",
    "join_tx_products",
    "measured_bytes",
    "names_as_of",
    "newest_names",
    "newest_rows",
    "normalize",
    "order_desc",
    "partition_share",
    "partition_total",
]
