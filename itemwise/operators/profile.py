"""Profiles: label distribution, class balance, distinct counts, conditional
counts, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemwise.operators.columns import col


def label_distribution(df: DataFrame, label: str = "lable_x") -> DataFrame:
    """(label, rows)."""
    return df.groupBy(col(label).alias(label)).agg(F.count(F.lit(1)).alias("rows"))


def class_balance(df: DataFrame, label: str = "lable_x", by: Sequence[str] = ()) -> DataFrame:
    """Rows, positives, positive share and negatives (per ``by`` group)."""
    y = col(label)
    return (df.groupBy(*[col(b) for b in by])
              .agg(F.count(F.lit(1)).alias("rows"),
                   F.count_if(y == 1).alias("positives"),
                   F.count_if(y == 0).alias("negatives"))
              .withColumn("positive_share", F.try_divide(F.col("positives").cast("double"),
                                                         F.col("rows"))))


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row with ``count_if`` of every named condition, in one pass."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def profile_nunique(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_distinct): exact distinct non-null values per column.

    Rows are unpivoted to (column, value text) pairs, de-duplicated with a
    map-side combined aggregate and counted per column: two shuffles for any
    number of columns, and a column with few values never funnels its rows
    into one task.
    """
    cols = list(cols or df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value"))
                      for c in cols])
    longf = df.select(F.inline(pairs)).where(F.col("value").isNotNull())
    distinct = longf.distinct()
    counted = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return (names.join(counted, "column", "left")
                 .select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct")))


# Sketches of 2**12 registers: one in three estimates is off by more than
# 1.04 / sqrt(2**12) = 1.6 %, and one in 370 by more than three times that.
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str] = ("ds",), cols: Sequence[str] | None = None,
                      bits: int = SKETCH_BITS) -> DataFrame:
    """(column, sketch, by...): a mergeable sketch of each column's non-null
    values within each group, such as a day.  One pass without a shuffle of
    values: a task sends some kilobytes for a column and group, however many
    values it has seen.  The table is small; kept as a stage by day, a new day
    adds its own sketches and reads nothing else."""
    cols = list(cols or [c for c in df.columns if c not in by])
    made = df.groupBy(*[col(b) for b in by]).agg(
        *[F.hll_sketch_agg(col(c).cast("string"), bits).alias(f"s{i}") for i, c in enumerate(cols)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])
    return made.select(F.inline(each), *[col(b) for b in by])


def sketched_nunique(sketches: DataFrame) -> DataFrame:
    """(column, n_estimate): distinct values over all given sketches; within
    ``SKETCH_ERROR`` of the exact count but for one column in some 370."""
    whole = sketches.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return whole.select("column", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("n_estimate"))


def distinct_with_null(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with null counted as one value (``unique`` semantics)."""
    c = col(column)
    return df.agg((F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0)))
                  .cast("long").alias("n_unique"))


def equal_width_histogram(df: DataFrame, column: str, bins: int = 1000) -> DataFrame:
    """(bin, lower, upper, rows) over ``bins`` equal-width bins between the
    column's min and max, nulls dropped, last bin closed on the right.
    Only non-empty bins are emitted.  Min and max are scalar subqueries, so
    the bin of each row is computed where the row is."""
    x = col(column).cast("double")
    vals = df.where(x.isNotNull()).select(x.alias("x"))
    lo = vals.select(F.min("x")).scalar()
    hi = vals.select(F.max("x")).scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).cast("int")
    return (vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
                .select("bin", (lo + F.col("bin") * width).alias("lower"),
                        (lo + (F.col("bin") + 1) * width).alias("upper"), "rows"))
