"""Report ordering."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_desc(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Sort by ``column``, largest first and NULLs at the top. With ``n``, only the first ``n`` rows (a top-k).

    Ties are ordered by the other columns, so that the order and the top-k are always the same, and so that a value many
    rows share doesn't end in one range partition.
    """
    others = [c for c in df.columns if c != column]
    ordered = df.orderBy(F.desc_nulls_first(column), *others)
    return ordered if n is None else ordered.limit(n)
