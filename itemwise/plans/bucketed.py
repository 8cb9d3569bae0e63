"""The title joins and the first row of a title on co-partitioned stages.

LABEL, DUA, the descriptions and ICI are each dealt to buckets of their title
once, when their stage is written.  All joins on the title then read bucket
by bucket, and so does the choice of a title's first row: none of them moves
a row.  A stage is worth it when it is read more than once; for a single pass
``merge.merge_sources`` needs no stages.

Rows without a title would all share a bucket, so they are kept in plain
tables and joined by ``merge``; only they meet each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itemwise.functions.jsoncols import LLM_KEYS, extract_flat
from itemwise.operators.clean import _order, drop_null_key
from itemwise.operators.columns import col, drop_strict, select_ordered
from itemwise.operators.joins import left_join_dimension, merge
from itemwise.plans import merge as M

BUCKETS = 64


@contextmanager
def bucket_tables(spark: SparkSession) -> Iterator[callable]:
    """``write(df, title, buckets)`` -> the bucketed table; all of them are
    dropped, with their files, at the end.  While the scope is open, rows that
    are together by title count as together for a join on (day, title) too:
    write the result inside."""
    made, whole = [], "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(whole)
    spark.conf.set(whole, "false")

    def write(df: DataFrame, title: str, buckets: int = BUCKETS) -> DataFrame:
        name = f"itemwise_{uuid.uuid4().hex}"
        made.append(name)
        (df.where(col(title).isNotNull()).repartition(buckets, col(title)).write.format("parquet")
         .bucketBy(buckets, title).sortBy(title).saveAsTable(name))
        return spark.table(name)

    try:
        yield write
    finally:
        spark.conf.set(whole, before)
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def described(llm: DataFrame, ssr: DataFrame) -> DataFrame:
    """LLM keys with the SSR statistics, as ``merge_sources`` joins them."""
    parsed = extract_flat(llm, "llm_nor", LLM_KEYS)
    stats = M.extract_stats(ssr)
    names = [c for c in stats.columns if c not in ssr.columns]
    stats = stats.drop(*[f"`ranked_categories.{c}`" for c, _ in M.STAT_COLUMNS])
    joined = left_join_dimension(parsed, stats, left_on=["category_second"], right_on=["ranked_categories.category_name"])
    kept = [c for c in M.LLM_SSR_KEEP if not c.startswith("ranked_categories.")]
    return select_ordered(joined, kept + names)


def merge_bucketed(label: DataFrame, dua: DataFrame, texts: DataFrame, ici: DataFrame, day: str = "ds",
                   null_equal: bool = False) -> DataFrame:
    """D1, D3 and D4 on tables that are bucketed by their titles (or, with
    ``null_equal``, on plain tables of the rows without one)."""
    def joined(left, right, on, left_on, right_on):
        return merge(left, right, on=on, left_on=[left_on], right_on=[right_on], null_equal=null_equal)

    ld = drop_strict(joined(label, dua, [day], "title", "item_title"), M.DUA_DROP)
    dx = joined(ld, texts, [], "title_x", "item_title")
    out = joined(dx, ici, [], "title_x", "title")
    return drop_strict(out, [c for c in M.FINAL_DROP if not c.startswith("ranked_categories.")])


def first_rows(raw: DataFrame, order, day: str = "ds", title: str = "title_x") -> DataFrame:
    """``clean_items`` over the buckets: a window on (title, day) needs no
    exchange where all rows of a title are in one bucket already."""
    w = Window.partitionBy(col(title), col(day)).orderBy(*_order(order))
    rows = drop_null_key(raw)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def untitled(label: DataFrame, dua: DataFrame, texts: DataFrame, ici: DataFrame) -> list[DataFrame]:
    """The rows of each source that have no title."""
    return [df.where(col(t).isNull()) for df, t in ((label, "title"), (dua, "item_title"), (texts, "item_title"), (ici, "title"))]
