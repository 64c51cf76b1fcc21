"""De-duplication with total orders (PRJ9, WIN3, DED1-DED4).

The reference keeps an arbitrary row per key (``dropDuplicates``) or orders by
a column that ties.  Here every step names a total order, so the same input
always yields the same representative; the *set of keys* kept is unchanged.

``keep_first`` is ``row_number() = 1`` over a window.  Spark plans it with a
partial ``WindowGroupLimit`` before the shuffle, so a hot key (even one holding
a third of all rows) reaches the exchange as one row per map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _sql(item) -> str:
    """A column name as a quoted SQL identifier; other strings are SQL as is."""
    return f"`{item}`" if item.isidentifier() else item


def keep_first(df: DataFrame, partition_by: Sequence, order_by: Sequence) -> DataFrame:
    """One row per ``partition_by`` key: the first in ``order_by`` order.

    Keys and order items are column names or SQL expressions (ascending,
    nulls first: Spark's default order)."""
    if all(isinstance(c, str) for c in [*partition_by, *order_by]):
        part = ", ".join(_sql(c) for c in partition_by)
        order = ", ".join(f"{_sql(c)} ASC NULLS FIRST" for c in order_by)
        rn = F.expr(f"row_number() OVER (PARTITION BY {part} ORDER BY {order})")
    else:
        rn = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def dedupe_pairs(df: DataFrame, a: str, b: str, within: Sequence[str], order_by: Sequence) -> DataFrame:
    """DED1/DED4: one row per undirected (a, b) pair within ``within``."""
    out = keep_first(
        df.selectExpr("*", f"least(`{a}`, `{b}`) AS _pair_lo", f"greatest(`{a}`, `{b}`) AS _pair_hi"),
        [*within, "_pair_lo", "_pair_hi"],
        order_by,
    )
    return out.drop("_pair_lo", "_pair_hi")


def dedupe_directed(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """DED2/DED3: one row per directed key, e.g. (origin, destination, route_name)."""
    return keep_first(df, keys, order_by)
