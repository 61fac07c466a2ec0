"""Order-as-data helpers shared by the item operators.

Row order never carries meaning in Spark, so every order-sensitive operator
takes an explicit order spec: a list of column names (ascending) or
``(name, ascending)`` pairs, e.g. ``[("uid", False), "pos"]`` for newest
message first, then document order. This module turns "position in that
order" into data without funnelling a large group through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsift.session import written

OrderSpec = Sequence["str | tuple[str, bool]"]


def _names(cols: Sequence[str] | str | None) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _pairs(order: OrderSpec) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def sort_exprs(order: OrderSpec, reverse: bool = False) -> list[Column]:
    """Sort expressions for an order spec (optionally reversed, nulls kept at the far end)."""
    out = []
    for name, asc in _pairs(order):
        if asc != reverse:
            out.append(F.col(name).asc_nulls_first())
        else:
            out.append(F.col(name).desc_nulls_last())
    return out


def order_columns(order: OrderSpec) -> list[str]:
    return [n for n, _ in _pairs(order)]


def ordinal(df: DataFrame, by: Sequence[str] | str | None, order: OrderSpec,
            name: str = "ordinal", skew_safe: bool = True,
            partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``name`` column: position of each row within ``by`` in ``order``.

    ``skew_safe=False`` is the plain ``row_number()`` window; a group is then
    sorted by one task, fine when groups are known to be small.

    ``skew_safe=True`` (default) never puts a whole group into one task. Rows
    are range-partitioned on ``by + order``, so a hot group is cut into
    consecutive slices, and **written once** with the number of their slice.
    Slice sizes and row positions are then both read from that table: two
    range exchanges would each sample their own bounds and not fit together.
    The running sum of the sizes of a group's slices, joined back null-safely,
    gives each slice its first position. The write runs when this is called.

    ``order`` must make rows unique within a group (ties would be numbered
    in an arbitrary order, exactly as with ``row_number``).
    """
    by = _names(by)
    if not skew_safe:
        w = Window.partitionBy(*by).orderBy(*sort_exprs(order)) if by \
            else Window.orderBy(*sort_exprs(order))
        return df.withColumn(name, F.row_number().over(w))

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut, place = "__slice", "__place"
    keys = [*[F.col(b).asc_nulls_first() for b in by], *sort_exprs(order)]
    # A group's rows of a slice stand together; the low 33 bits number a task's rows.
    ranged = written(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias(cut),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(place)), "ordinal", "zstd")
    before = Window.partitionBy(*by).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    first = (ranged.groupBy(*by, cut).agg(F.count(F.lit(1)).alias("__n"), F.min(place).alias("__low"))
             .select(F.col(cut).alias("__of"), *[F.col(b).alias(f"__of_{b}") for b in by],
                     (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__low"))
                     .alias("__before")))
    same = F.col(cut) == F.col("__of")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__of_{b}"))
    return (ranged.join(first, same)
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("__before") + F.col(place) + 1).cast("int").alias(name)))


def first_per_key(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """Keep the first row of each ``keys`` group in ``order`` (first wins).

    ``row_number() <= 1`` plans as ``WindowGroupLimit`` partial + final, so
    each map task ships at most one row per key: a key that holds a third of
    all rows is reduced map-side before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*sort_exprs(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= 1).drop("__rn")


def last_k_per_group(df: DataFrame, by: Sequence[str], order: OrderSpec, k: int) -> DataFrame:
    """The last ``k`` rows of each group in ``order`` (reverse top-k, map-side limited)."""
    rev = sort_exprs(order, reverse=True)
    w = Window.partitionBy(*by).orderBy(*rev) if by else Window.orderBy(*rev)
    return df.withColumn("__rk", F.row_number().over(w)).filter(F.col("__rk") <= k).drop("__rk")
