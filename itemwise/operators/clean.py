"""Cleaning, deduplication and labelling of the daily item table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from itemwise.functions import labels as L
from itemwise.operators.columns import col


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.distinct()


def drop_null_key(df: DataFrame, cols: Sequence[str] = ("category_name",)) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def _order(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """Sort columns; nulls come first either way."""
    return [col(c).asc_nulls_first() if asc else col(c).desc_nulls_first() for c, asc in order]


def dedup_keep_first(df: DataFrame, keys: Sequence[str],
                     order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row per key: the first by ``order``, which should be total up to
    equal rows.  Narrow order columns keep all other columns prunable.

    ``row_number() = 1`` is planned with a partial group limit before the
    shuffle, so of a key that holds a third of all rows each task sends one.
    """
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*_order(order))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_in_file_order(df: DataFrame, keys: Sequence[str], positions: Sequence[str]) -> DataFrame:
    """One row per key: the first as if the files had been read one after
    another and joined in memory, where a left join keeps the order of its
    left rows and, for each, that of its matches.  ``positions`` are the place
    columns of the joined sources (``sources.dated``), left to right; they are
    narrow, and dropped from the result."""
    return dedup_keep_first(df, keys, [(p, True) for p in positions]).drop(*positions)


def clean_items(df: DataFrame, title: str = "title_x", category: str = "category_name",
                ds: str | None = "ds", order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """distinct -> non-null category -> one row per title (per day).

    Whole-row copies are equal candidates for the first row, so the distinct
    cannot change the result; it is therefore not run as its own shuffle
    (``step_counts`` still reports it)."""
    keys = ([ds] if ds and ds in df.columns else []) + [title]
    return dedup_keep_first(drop_null_key(df, [category]), keys, order)


def label_items(df: DataFrame, rule: str = "a", label: str = "lable_x",
                buy: str = "buy_num_x", click: str = "click_num_x",
                weekly: str | None = "weekly_order_cnt",
                weekly_max: int | None = L.RULE_A_WEEKLY_MAX) -> DataFrame:
    """Remove single-buy rows, attach the label, keep labelled rows only."""
    if rule == "a":
        expr = L.label_rule_a(buy, click, weekly, weekly_max)
    elif rule == "b":
        expr = L.label_rule_b(buy, click)
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return (df.where(L.not_single_buy(buy))
              .withColumn(label, expr)
              .where(col(label).isNotNull()))


def tighten(df: DataFrame, label: str = "lable_x", weekly: str = "weekly_order_cnt",
            weekly_max: int = L.TIGHTEN_WEEKLY_MAX) -> DataFrame:
    return df.where(L.tighten_negatives(label, weekly, weekly_max))


def funnel_filter(df: DataFrame, push: str = "push_num", click: str = "click_num") -> DataFrame:
    """Plausible funnels only: more pushes than clicks and at least one click."""
    return df.where((col(push) > col(click)) & (col(click) > 0))


def step_counts(df: DataFrame, title: str = "title_x", category: str = "category_name",
                ds: str | None = "ds", rule: str = "a",
                order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """Rows after each cleaning and labelling step, from one grouped pass:
    copies are counted, the first row of each title is numbered, and every
    step is a conditional sum."""
    keys = ([ds] if ds and ds in df.columns else []) + [title]
    rows = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__c"))
    known = col(category).isNotNull()
    w = Window.partitionBy(*[col(k) for k in keys], known).orderBy(*_order(order))
    label = L.label_rule_a() if rule == "a" else L.label_rule_b()
    first = known & (F.row_number().over(w) == 1)
    rows = rows.select("__c", known.alias("__k"), first.alias("__f"), L.not_single_buy().alias("__b"),
                       label.isNotNull().alias("__l"))
    f, b = F.col("__f"), F.coalesce("__b", F.lit(False))
    steps = {"input": F.sum("__c"), "distinct": F.count(F.lit(1)), "non_null_category": F.count_if(F.col("__k")),
             "one_per_title": F.count_if(f), "not_single_buy": F.count_if(f & b),
             "labelled": F.count_if(f & b & F.col("__l"))}
    one = rows.agg(*[F.coalesce(v, F.lit(0)).cast("long").alias(n) for n, v in steps.items()])
    lines = [F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(n).alias("rows"))
             for i, n in enumerate(steps)]
    return one.select(F.inline(F.array(*lines)))


def _with_join_keys(df: DataFrame, title: str) -> tuple[DataFrame, list[str]]:
    """``df`` with the two values by which a null-safe join on ``title`` deals
    out its rows, and their names.  They follow from the title, so they change
    neither copies nor groups; but rows that come from such a join lie
    together by them, so no further shuffle of whole rows is planned."""
    if df.schema[title].dataType.typeName() != "string":
        return df, []
    near = {"__given": F.coalesce(col(title), F.lit("")), "__absent": col(title).isNull()}
    return df.withColumns(near), list(near)


class CleaningCounts:
    """Row counts of the cleaning steps, observed while the cleaned table is
    written: no step is computed a second time to be counted.

    ``cleaned`` gives the table; after one action on it ``rows`` holds the
    counts under the names of ``step_counts``.  Without ``distinct`` the copies
    are not removed by a step of their own (the first row of a title is the
    same): that count is missing, and ``non_null_category`` counts copies.  Values that are no JSON objects are
    counted at the input, a column each, under ``corrupt:<column>``."""

    STEPS = ("input", "distinct", "non_null_category", "one_per_title", "not_single_buy", "labelled")

    def __init__(self, distinct: bool = False, json: Sequence[str] = ()):
        self.json = list(json)
        self.steps = {s: Observation() for s in self.STEPS if distinct or s != "distinct"}

    def _seen(self, df: DataFrame, step: str) -> DataFrame:
        counts = [F.count(F.lit(1)).alias("rows")]
        if step == "input":
            counts += [F.count_if(col(c).isNotNull() & F.from_json(col(c), "map<string,string>").isNull())
                       .alias(f"corrupt:{c}") for c in self.json]
        return df.observe(self.steps[step], *counts)

    def cleaned(self, df: DataFrame, title: str = "title_x", category: str = "category_name", ds: str | None = "ds",
                rule: str = "a", order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
        keys = ([ds] if ds and ds in df.columns else []) + [title]
        df = self._seen(df, "input").drop(*self.json)
        near: list[str] = []
        if "distinct" in self.steps:
            df, near = _with_join_keys(df, title)
            df = self._seen(distinct_rows(df), "distinct")
        df = self._seen(drop_null_key(df, [category]), "non_null_category")
        df = self._seen(dedup_keep_first(df, [*keys, *near], order).drop(*near), "one_per_title")
        df = self._seen(df.where(L.not_single_buy()), "not_single_buy")
        return self._seen(label_items(df, rule), "labelled")

    @property
    def rows(self) -> dict[str, int]:
        """Waits for the action on the table that was asked for."""
        out = {}
        for step, seen in self.steps.items():
            got = dict(seen.get)
            out[step] = got.pop("rows")
            out |= got
        return out
