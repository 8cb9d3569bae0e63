"""Stand-ins: the item pipeline's input tables derived from the driver's
TPC-H-like tables, so every query reads real, scale-growing data.

| role             | built from                                   | grain          |
|------------------|----------------------------------------------|----------------|
| LABEL (daily)    | lineitem: clicks = lines, buys = flag 'A'    | (year, part)   |
| DUA (daily)      | lineitem x part: item attributes, weekly     | (year, part)   |
| LLM (snapshot)   | part: a JSON description with 13 keys        | part           |
| ICI (snapshot)   | lineitem: conversion totals per part         | part           |
| SSR (csv)        | part by brand: four JSON statistics columns  | brand          |
| CATEGORY_FEATURE | part by (type, brand)                        | (type, brand)  |
| BLACKLIST        | the brands of two named values               | brand          |

The year of ``l_shipdate`` plays the day ``ds``.  Some DUA rows carry no
item title (parts larger than size 45) so the label join has orphans;
some LLM values are malformed, a JSON array or null; some SSR statistics
use another outer key or are cut short.  All of it is decided by column
values, never by sampling rows.

The SQL below runs unchanged in Spark and DuckDB; ``{q}`` is the
identifier quote of the engine (back-tick or double quote).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

LABEL_SQL = """
SELECT CAST(year(l_shipdate) AS STRING) AS ds,
       CAST(l_partkey AS STRING) AS title,
       count_if(l_returnflag = 'A') AS buy_num,
       count(*) AS click_num
FROM lineitem
GROUP BY year(l_shipdate), l_partkey
"""

_DUA_ONE = """
SELECT CAST(year(l.l_shipdate) AS STRING) AS ds,
       CASE WHEN p.p_size <= 45 THEN CAST(p.p_partkey AS STRING) END AS item_title,
       p.p_name AS title,
       count_if(l.l_returnflag = 'R') AS buy_num,
       count(*) AS click_num,
       concat('u/', CAST(p.p_partkey AS STRING)) AS coupons_share_url,
       CAST(p.p_partkey AS STRING) AS goods_id,
       CAST(p.p_partkey AS STRING) AS item_id,
       CAST(year(l.l_shipdate) AS STRING) AS {q}update{q},
       count(*) AS row_num,
       CAST(p.p_partkey AS STRING) AS item_id_temp,
       p.p_brand AS category_name,
       p.p_type AS level_one_category_name,
       split_part(p.p_name, ' ', 1) AS brand_name,
       concat('shop', CAST(min(l.l_suppkey) AS STRING)) AS shop_title,
       count_if(l.l_linestatus = 'O') AS weekly_order_cnt,
       p.p_retailprice AS zk_final_price,
       max(l.l_extendedprice) AS reserve_price,
       min(l.l_extendedprice) AS final_promotion_price,
       max(l.l_discount) AS daily_browse_ratio,
       min(l.l_tax) AS weekly_browse_ratio,
       max(l.l_tax) AS monthly_browse_ratio,
       sum(l.l_quantity) AS daily_browse_cnt
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY year(l.l_shipdate), p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size,
         p.p_retailprice
"""

# Some rows come twice, and some items have a second match with another shop.
DUA_SQL = f"""
SELECT * FROM ({_DUA_ONE}) a
UNION ALL SELECT * FROM ({_DUA_ONE}) b WHERE row_num % 5 = 0
UNION ALL SELECT ds, item_title, title, buy_num, click_num, coupons_share_url, goods_id, item_id,
       {{q}}update{{q}}, row_num, item_id_temp, category_name, level_one_category_name, brand_name,
       concat(shop_title, 'b') AS shop_title, weekly_order_cnt + 1 AS weekly_order_cnt, zk_final_price,
       reserve_price, final_promotion_price, daily_browse_ratio, weekly_browse_ratio,
       monthly_browse_ratio, daily_browse_cnt
  FROM ({_DUA_ONE}) c WHERE row_num % 4 = 1
"""

LLM_SQL = """
SELECT CAST(p_partkey AS STRING) AS item_title,
  CASE
    WHEN p_size = 1 THEN concat('{"category_first":"', p_type)
    WHEN p_size = 2 THEN '[]'
    WHEN p_size = 3 THEN NULL
    ELSE concat(
      '{"category_first":"', p_type,
      '","category_second":"', p_brand,
      '","brand_real":"', p_brand, ';', replace(p_name, ' ', ';'),
      '","brand_quality":"q', CAST(p_size % 3 AS STRING),
      CASE WHEN p_size > 10
           THEN concat('","audience":"', p_type, CASE WHEN p_size > 30 THEN ';all' ELSE '' END)
           ELSE '' END,
      '","subj_scenario":"s', CAST(p_size % 4 AS STRING),
      '","obj_scenario":"o","time_scenario":"t","dep_scenario":"d","feature":"',
      CASE WHEN p_size > 25
           THEN concat(replace(p_name, ' ', ';'), ';', p_type, ';', p_brand,
                       ';s', CAST(p_size % 5 AS STRING), ';m', CAST(p_size % 3 AS STRING),
                       ';', p_type)
           ELSE replace(p_name, ' ', ';') END,
      '","category":"', p_type,
      '","scenario":"', replace(p_name, ' ', ';'), CASE WHEN p_size > 40 THEN ';' ELSE '' END,
      '","brand":"', p_brand, '"}')
  END AS llm_nor
FROM part
"""

_ICI_ONE = """
SELECT CAST(l_partkey AS STRING) AS title,
       CAST(l_partkey AS STRING) AS item_id,
       count(*) AS click_sum,
       count_if(l_returnflag = 'A') AS buy_sum,
       CAST(count_if(l_returnflag = 'A') AS DOUBLE) / count(*) AS convert_rate,
       CAST(floor(sum(l_quantity)) AS BIGINT) AS ici_push_total,
       max(l_extendedprice) AS gmv_sum,
       min(l_extendedprice) AS commission_sum,
       concat('ici', CAST(count(*) AS STRING)) AS ici,
       'card' AS ici_card
FROM lineitem
GROUP BY l_partkey
"""

# Some items have totals of two runs.
ICI_SQL = f"""
SELECT * FROM ({_ICI_ONE}) a
UNION ALL SELECT title, item_id, click_sum + 1 AS click_sum, buy_sum, convert_rate, ici_push_total, gmv_sum,
       commission_sum, ici, ici_card FROM ({_ICI_ONE}) b WHERE click_sum % 6 = 0
"""


def _stat(outer: str, a: str, b: str) -> str:
    """SQL building ``{"<outer>": {11 statistics}}`` text from integers."""
    return f"""concat('{{"{outer}":{{"raw_max":', CAST(max({a}) AS STRING),
      ',"raw_min":', CAST(min({a}) AS STRING),
      ',"raw_count":', CAST(count(*) AS STRING),
      ',"max_":', CAST(max({b}) AS STRING),
      ',"mean_":', CAST(count(DISTINCT {b}) AS STRING),
      ',"mid_":"', CAST(min({b}) + max({b}) AS STRING),
      '","min_":', CAST(min({b}) AS STRING),
      ',"count_":', CAST(count(DISTINCT {a}) AS STRING),
      ',"group_by":"brand","unit":"pcs","update_time":"2024-12-23 13:40"}}}}')"""


SSR_SQL = f"""
SELECT p_brand AS {{q}}ranked_categories.category_name{{q}},
  {_stat('annual_volJson', 'p_size', 'p_size')} AS {{q}}ranked_categories.annual_voljson{{q}},
  {_stat('priceJson', 'CAST(floor(p_retailprice) AS BIGINT)', 'p_size')} AS {{q}}ranked_categories.pricejson{{q}},
  CASE WHEN count(*) % 2 = 0
       THEN {_stat('discountJson', 'p_size', 'p_size')}
       ELSE {_stat('discount', 'p_size', 'p_size')} END AS {{q}}ranked_categories.discountjson{{q}},
  CASE WHEN max(p_size) - min(p_size) < 49
       THEN {_stat('p_diffJson', 'p_size', 'CAST(floor(p_retailprice) AS BIGINT)')}
       ELSE '{{"p_diffJson": {{"raw_max": 1' END AS {{q}}ranked_categories.p_diffjson{{q}}
FROM part
GROUP BY p_brand
"""

CATEGORY_FEATURE_SQL = """
SELECT p_type AS level_one_category_name,
       p_brand AS category_name,
       CAST(count(*) AS DOUBLE) AS tb_push,
       max(p_retailprice) AS tb_pay_money,
       CAST(min(p_size) AS DOUBLE) / 50 AS tb_ctr,
       CAST(max(p_size) AS DOUBLE) / 50 AS tb_cvr
FROM part
GROUP BY p_type, p_brand
"""

BLACKLIST_SQL = """
SELECT DISTINCT p_brand AS category_name FROM part WHERE p_brand IN ('Brand#1', 'Brand#13')
"""

STANDINS = {
    "label_src": LABEL_SQL,
    "dua_src": DUA_SQL,
    "llm_src": LLM_SQL,
    "ici_src": ICI_SQL,
    "ssr_src": SSR_SQL,
    "category_feature_src": CATEGORY_FEATURE_SQL,
    "blacklist_src": BLACKLIST_SQL,
}


def sql_for(name: str, quote: str) -> str:
    return STANDINS[name].replace("{q}", quote)


def register_tables(spark: SparkSession, sf_dir: str, tables=TABLES) -> None:
    """Expose the driver's parquet tables as temp views (lazy scans)."""
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def _with_copies(one: DataFrame, again: list[tuple[str, dict[str, str]]]) -> DataFrame:
    """The rows of ``one`` and, for each (condition, changed columns), those
    that meet it once more: what the UNION ALL states, with ``one`` aggregated
    once instead of once for each branch."""
    copies = F.array_compact(F.array(F.lit(0), *[F.when(F.expr(met), F.lit(i)) for i, (met, _) in enumerate(again, 1)]))
    rows = one.withColumn("__copy", F.explode(copies))
    for i, (_, changed) in enumerate(again, 1):
        rows = rows.withColumns({c: F.when(F.col("__copy") == i, F.expr(e)).otherwise(F.col(c)) for c, e in changed.items()})
    return rows.drop("__copy")


# The stand-ins that repeat rows: their base rows and the branches of the SQL.
REPEATED = {
    "dua_src": (_DUA_ONE, [("row_num % 5 = 0", {}),
                           ("row_num % 4 = 1", {"shop_title": "concat(shop_title, 'b')",
                                                "weekly_order_cnt": "weekly_order_cnt + 1"})]),
    "ici_src": (_ICI_ONE, [("click_sum % 6 = 0", {"click_sum": "click_sum + 1"})]),
}


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in table as a lazy DataFrame over the driver's tables."""
    register_tables(spark, sf_dir, _needs(name))
    if name in REPEATED:
        one, again = REPEATED[name]
        return _with_copies(spark.sql(one.replace("{q}", "`")), again)
    return spark.sql(sql_for(name, "`"))


def _needs(name: str) -> list[str]:
    return [t for t in ("lineitem", "part") if t in STANDINS[name]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def duck_ctes(*names: str) -> str:
    """``WITH`` fragments for the DuckDB oracle (same SQL as the Spark side)."""
    return ",\n".join(f"{n} AS ({sql_for(n, chr(34))})" for n in names)
