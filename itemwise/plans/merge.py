"""Entry 1: join the daily item sources into one raw feature table.

LABEL ⟕ DUA (day, title) -> LLM JSON keys ⟕ SSR (broadcast when small)
-> ⟕ on title -> four JSON statistics columns -> ⟕ ICI on title.
All days run in one job; ``ds`` is a join key wherever both sides carry it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from itemwise.functions.jsoncols import LLM_KEYS, extract_flat, extract_nested
from itemwise.operators.columns import drop_strict, select_ordered
from itemwise.operators.joins import left_join_dimension, merge

# Columns removed / kept between the joins.
DUA_DROP = ["item_title", "buy_num_y", "click_num_y", "coupons_share_url", "goods_id",
            "item_id", "title_y", "update", "row_num", "item_id_temp"]
LLM_SSR_KEEP = ["item_title", "scenario", "category", "feature", "dep_scenario",
                "time_scenario", "obj_scenario", "subj_scenario", "audience",
                "brand_quality", "brand_real", "category_second", "category_first",
                "ranked_categories.annual_voljson", "ranked_categories.pricejson",
                "ranked_categories.discountjson", "ranked_categories.p_diffjson"]
STAT_COLUMNS = [("annual_voljson", "annual_volJson"), ("pricejson", "priceJson"),
                ("discountjson", "discountJson"), ("p_diffjson", "p_diffJson")]
STAT_DROP = ["annual_voljson_group_by", "annual_voljson_unit", "annual_voljson_update_time",
             "pricejson_group_by", "pricejson_unit",
             "discountjson_count_", "discountjson_group_by", "discountjson_unit",
             "discountjson_update_time",
             "p_diffjson_group_by", "p_diffjson_unit", "p_diffjson_update_time"]
FINAL_DROP = ["item_title", "ranked_categories.annual_voljson", "ranked_categories.pricejson",
              "ranked_categories.discountjson", "ranked_categories.p_diffjson", "item_id", "title"]


def _days(a: DataFrame, b: DataFrame, day: str) -> list[str]:
    return [day] if day in a.columns and day in b.columns else []


def label_with_items(label: DataFrame, dua: DataFrame, day: str = "ds") -> DataFrame:
    """LABEL ⟕ DUA on title = item_title (null-safe), bookkeeping dropped."""
    ld = merge(label, dua, on=_days(label, dua, day), left_on=["title"],
               right_on=["item_title"], how="left", split_nulls=True)
    return drop_strict(ld, DUA_DROP)


def descriptions_with_stats(llm: DataFrame, ssr: DataFrame, day: str = "ds") -> DataFrame:
    """LLM keys ⟕ SSR on category_second, reduced to the 17 used columns."""
    parsed = extract_flat(llm, "llm_nor", LLM_KEYS)
    joined = left_join_dimension(parsed, ssr, on=_days(parsed, ssr, day),
                                 left_on=["category_second"],
                                 right_on=["ranked_categories.category_name"])
    return select_ordered(joined, _days(parsed, ssr, day) + LLM_SSR_KEEP)


def extract_stats(df: DataFrame) -> DataFrame:
    for c, outer in STAT_COLUMNS:
        df = extract_nested(df, f"ranked_categories.{c}", outer, prefix=c)
    return drop_strict(df, STAT_DROP)


def merge_sources(label: DataFrame, dua: DataFrame, llm: DataFrame, ssr: DataFrame,
                  ici: DataFrame, day: str = "ds", carry: Sequence[str] = ()) -> DataFrame:
    """The raw table of all days (one row per label row and match); ``carry``
    names further columns of the descriptions to keep, such as their places."""
    ld = label_with_items(label, dua, day)
    parsed = extract_flat(llm, "llm_nor", LLM_KEYS)
    stats = extract_stats(ssr)
    stat_names = [c for c in stats.columns if c not in ssr.columns]
    stats = stats.drop(*[f"`ranked_categories.{c}`" for c, _ in STAT_COLUMNS])
    days = _days(parsed, stats, day)
    ls = left_join_dimension(parsed, stats, on=days, left_on=["category_second"],
                             right_on=["ranked_categories.category_name"])
    kept = [c for c in LLM_SSR_KEEP if not c.startswith("ranked_categories.")]
    ls = select_ordered(ls, days + kept + stat_names + list(carry))
    dx = merge(ld, ls, on=_days(ld, ls, day), left_on=["title_x"], right_on=["item_title"],
               how="left")
    final = merge(dx, ici, on=_days(dx, ici, day), left_on=["title_x"], right_on=["title"],
                  how="left")
    return drop_strict(final, [c for c in FINAL_DROP if not c.startswith("ranked_categories.")])
