"""Running totals and dense positions over a global order, without a
single-task window.

A window ``ORDER BY x`` with no ``PARTITION BY`` moves every row into one
task.  Here the rows are range-partitioned on the order key instead (and
written once, so the partition of a row is fixed); each
partition's totals (one row per partition and group) are summed into
offsets, which are broadcast back, and the local running total inside each
range partition is added to its offset.  Ranges follow the groups, so a
partition goes on with at most one group of the partition before; only such
groups have an offset, which bounds the broadcast by the partition count
however many groups there are.  Null is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemwise.session import write_scratch

DEFAULT_RANGES = 64


def _n_ranges(df: DataFrame, ranges: int | None) -> int:
    if ranges:
        return ranges
    try:
        return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    except Exception:  # pragma: no cover - conf always set in practice
        return DEFAULT_RANGES


def running_totals(df: DataFrame, order: Sequence[Column], sums: dict[str, Column],
                   group: Sequence[str] = (), ranges: int | None = None,
                   inclusive: bool = True, keep_range: str | None = None) -> DataFrame:
    """Append ``<name>`` = running sum of each expression in ``sums`` over
    ``order`` (ascending; put ``F.desc`` in ``order`` for descending) within
    ``group``.  Rows must be unique in (group, order) for the sum to be
    well defined, e.g. after grouping by the order key.
    ``inclusive=False`` gives the sum of the rows strictly before;
    ``keep_range`` names a column for the number of the row's range."""
    group = list(group)
    n = _n_ranges(df, ranges)
    base = df.select("*", *[e.alias(f"__v_{k}") for k, e in sums.items()])
    # The partition id must be the same in both branches below and after a
    # task retry, so the range-partitioned rows are written once.
    part = write_scratch(base.repartitionByRange(n, *[F.col(g) for g in group], *order)
                         .withColumn("__pid", F.spark_partition_id()), "ranges")
    totals = part.groupBy(*group, "__pid").agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums])
    before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    placed = Window.partitionBy(*group).orderBy("__pid")
    offsets = (totals.select(*[F.col(g).alias(f"__g_{g}") for g in group], F.col("__pid").alias("__range"),
                             *[F.sum(f"__t_{k}").over(before).alias(f"__o_{k}") for k in sums],
                             F.row_number().over(placed).alias("__nth"))
               .where("__nth > 1").drop("__nth"))
    local_end = Window.unboundedPreceding, (Window.currentRow if inclusive else -1)
    w = Window.partitionBy(*group, "__pid").orderBy(*order).rowsBetween(*local_end)
    # At most one row for each range.
    same = F.col("__pid") == F.col("__range")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    out = part.join(F.broadcast(offsets), same, "left").drop("__range", *[f"__g_{g}" for g in group])
    for k in sums:
        out = out.withColumn(k, F.coalesce(F.col(f"__o_{k}"), F.lit(0)) + F.coalesce(F.sum(f"__v_{k}").over(w), F.lit(0)))
    if keep_range:
        out = out.withColumn(keep_range, F.col("__pid"))
    return out.drop("__pid", *[f"__v_{k}" for k in sums], *[f"__o_{k}" for k in sums])


def dense_positions(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (),
                    name: str = "position", ranges: int | None = None) -> DataFrame:
    """0-based position of each (already distinct) row in ``order`` within
    ``group``: the running count of the rows before it."""
    out = running_totals(df, order, {name: F.lit(1).cast("long")}, group, ranges, inclusive=False)
    return out
