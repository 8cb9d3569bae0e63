"""Sampling and splitting: balanced sample, shuffle, hash split, time split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemwise.functions.prefix import dense_positions
from itemwise.operators.columns import col

# Fixed values of the balanced sample sheet.
SAMPLE_COLUMNS = ["tb_push", "scenario_1", "tb_pay_money", "tb_cvr", "reserve_price",
                  "weekly_browse_ratio", "daily_browse_ratio", "daily_browse_cnt",
                  "monthly_browse_ratio", "final_promotion_price", "shop_title",
                  "feature1", "tb_ctr", "level_one_category_name", "category_name",
                  "zk_final_price", "convert_rate", "lable_x"]
SAMPLE_PER_CLASS = 1000
PARTS = 16


def balanced_sample(df: DataFrame, n: int = SAMPLE_PER_CLASS, label: str = "lable_x",
                    cols: Sequence[str] | None = None,
                    order: Sequence[str] | None = None) -> DataFrame:
    """Rows complete in ``cols``; the first ``n`` of each class in ``order``.

    Two group limits: the first inside hash parts of each class, so the tasks
    that finish a class get at most ``n`` rows from each of ``PARTS`` parts,
    whatever the number of input partitions."""
    cols = list(cols or [c for c in SAMPLE_COLUMNS if c in df.columns])
    order = list(order or cols)
    kept = df.select(*[col(c) for c in cols]).na.drop(subset=cols)
    kept = kept.withColumn("__part", F.pmod(F.xxhash64(*[col(c) for c in order]), F.lit(PARTS)))
    for by in ([col(label), F.col("__part")], [col(label)]):
        w = Window.partitionBy(*by).orderBy(*[col(c) for c in order])
        kept = kept.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
    return kept.drop("__part")


def shuffle_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    """All rows in a random (seeded) order."""
    return df.orderBy(F.rand(seed))


def _keyed(seed: int | str, key: Sequence[str]) -> Column:
    """MD5 of the seed and the key's values, each told from null and from its neighbours."""
    parts = [F.coalesce(F.concat(F.length(col(k).cast("string")).cast("string"), F.lit(":"), col(k).cast("string")),
                        F.lit("-")) for k in key]
    return F.md5(F.concat(F.lit(f"{seed}|"), *parts))


def shuffled(df: DataFrame, key: Sequence[str], seed: int = 42, index: str = "index") -> DataFrame:
    """All rows in a random order, with their new places 0..n-1 in ``index``.

    The order is that of a hash of the seed and the ``key`` columns, so it is
    the same for any partitioning and after a lost task; rows with equal keys
    (also hot ones) follow each other in any order.  Rows are dealt to ranges
    of the hash and numbered there, so no task sees all of them."""
    rows = df.withColumns({"__h": _keyed(seed, key), "__r": F.monotonically_increasing_id()})
    return dense_positions(rows, [F.asc("__h"), F.asc("__r")], name=index).drop("__h", "__r")


def keyed_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2), names: Sequence[str] = ("train", "test"),
                seed: int = 42, buckets: int = 10_000) -> DataFrame:
    """``hash_split`` by MD5 of a seed and the key, which any engine can state:
    the first eight hexadecimal digits, modulo ``buckets``."""
    bucket = F.pmod(F.conv(F.substring(_keyed(seed, [key]), 1, 8), 16, 10).cast("long"), F.lit(buckets))
    return _split_by(df, bucket, weights, names, buckets)


def hash_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2),
               names: Sequence[str] = ("train", "test"), buckets: int = 10_000) -> DataFrame:
    """Label every row with a split chosen from a hash of ``key``: the same
    key always lands in the same split, also when a lost task is recomputed
    (``randomSplit`` depends on the partition layout instead)."""
    return _split_by(df, F.pmod(F.xxhash64(col(key)), F.lit(buckets)), weights, names, buckets)


def _split_by(df: DataFrame, b: Column, weights: Sequence[float], names: Sequence[str], buckets: int) -> DataFrame:
    total = float(sum(weights))
    expr, acc = None, 0.0
    for w, n in zip(weights, names):
        acc += w / total
        cond = b < F.lit(int(round(acc * buckets)))
        expr = F.when(cond, F.lit(n)) if expr is None else expr.when(cond, F.lit(n))
    return df.withColumn("split", expr.otherwise(F.lit(names[-1])))


def three_way_split(df: DataFrame, key: str) -> DataFrame:
    """'train' 80 %, and of the rest 'valid' 75 % and 'test' 25 %."""
    return hash_split(df, key, (0.8, 0.15, 0.05), ("train", "valid", "test"))


def time_split(df: DataFrame, cut: str, ds: str = "ds") -> DataFrame:
    """'train' for days up to and including ``cut``, 'test' after it."""
    return df.withColumn("split", F.when(col(ds) <= F.lit(cut), F.lit("train"))
                         .when(col(ds) > F.lit(cut), F.lit("test")))
