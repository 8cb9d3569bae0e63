"""Registered queries on file order, growing stages and measured plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise import schemas as SC
from itemwise.operators import clean as C
from itemwise.operators import conflicts as CF
from itemwise.operators import profile as P
from itemwise.operators import sample as SP
from itemwise.operators import tokens as TK
from itemwise.plans import bucketed as B
from itemwise.plans import merge as M
from itemwise.plans import oracle as O
from itemwise.plans import prepare as PR
from itemwise.plans.catalog import CLEAN_SQL, EXPAND_VIEW, LABEL_VIEW, ORACLE, Ctx, query, r6
from itemwise.session import scratch_path, skewed_joins_split, write_scratch
from itemwise.sources import dated as DT
from itemwise.sources import files as FI
from itemwise.sources import manifest as MF


def keyed_sql(seed, key) -> str:
    """``sample._keyed`` in SQL."""
    parts = " || ".join(f"coalesce(length(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR), '-')" for k in key)
    return f"md5('{seed}|' || {parts})"


# --- first rows in file order -------------------------------------------------

# Columns that tell the rows of a source apart, up to copies.
FILE_KEYS = {"label_src": ["ds", "title"], "dua_src": ["ds", "goods_id", "shop_title", "weekly_order_cnt"],
             "ici_src": ["title", "click_sum"], "llm_src": ["item_title"]}


def _as_files(ctx: Ctx, name: str, schema, position: str) -> DataFrame:
    """The source written as several files, in an order that its columns do
    not show (that of a hash), and read back with each row's place."""
    src = ctx.src(name).withColumn("__h", SP._keyed("file", FILE_KEYS[name]))
    days = ["ds"] if "ds" in src.columns else []
    # As many files as the session has shuffle partitions, 3 at least: a task's share does not grow with the table.
    parts = max(3, int(ctx.spark.conf.get("spark.sql.shuffle.partitions")))
    rows = src.repartitionByRange(parts, "__h").sortWithinPartitions(*days, "__h").drop("__h")
    root = scratch_path(ctx.spark, "in-order")
    if days:
        rows.write.partitionBy("ds").parquet(root)
        return DT.scan_dated(ctx.spark, root, "ds=", schema, position=position)
    rows.write.parquet(root)
    return DT.with_position(ctx.spark.read.schema(schema).parquet(root), position)


AT = ["__at_label", "__at_dua", "__at_llm", "__at_ici"]


def _placed_raw(ctx: Ctx) -> DataFrame:
    at = AT
    return M.merge_sources(_as_files(ctx, "label_src", SC.LABEL, at[0]), _as_files(ctx, "dua_src", SC.DUA, at[1]),
                           _as_files(ctx, "llm_src", SC.LLM, at[2]), ctx.src("ssr_src"),
                           _as_files(ctx, "ici_src", SC.ICI, at[3]), carry=[at[2]])


def _first_in_file_order(spark, d):
    return C.first_in_file_order(C.drop_null_key(_placed_raw(Ctx(spark, d))), ["ds", "title_x"], AT)


_PLACED = O.RAW_BASE
for _old, _new in (
        ("SELECT l.ds, l.title AS title_x", "SELECT l.lk, d.dk, l.ds, l.title AS title_x"),
        ("FROM label_src l LEFT JOIN dua_src d", f"FROM (SELECT *, {keyed_sql('file', FILE_KEYS['label_src'])} AS lk FROM label_src) l "
         f"LEFT JOIN (SELECT *, {keyed_sql('file', FILE_KEYS['dua_src'])} AS dk FROM dua_src) d"),
        ("SELECT r.*, ", "SELECT r.*, i.ik, "),
        ("LEFT JOIN ici_src i", f"LEFT JOIN (SELECT *, {keyed_sql('file', FILE_KEYS['ici_src'])} AS ik FROM ici_src) i")):
    assert _PLACED.count(_old) == 1, _old
    _PLACED = _PLACED.replace(_old, _new)

query("first_in_file_order",
      f"WITH {_PLACED} SELECT * EXCLUDE (rn, lk, dk, ik) FROM (SELECT *, row_number() OVER (PARTITION BY ds, title_x "
      "ORDER BY lk, dk, ik) AS rn FROM raw WHERE category_name IS NOT NULL) WHERE rn = 1")(_first_in_file_order)


query("label_items_in_file_order",
      f"WITH {_PLACED}, raw_first AS (SELECT * EXCLUDE (rn, lk, dk, ik) FROM (SELECT *, row_number() OVER "
      "(PARTITION BY ds, title_x ORDER BY lk, dk, ik) AS rn FROM raw WHERE category_name IS NOT NULL) WHERE rn = 1),\n"
      f"{O.labelled('a', 7)}\nSELECT {', '.join(LABEL_VIEW)}, shop_title, click_sum FROM labelled")(
    lambda spark, d: PR.clean_and_label(_placed_raw(Ctx(spark, d)), positions=AT).select(*LABEL_VIEW, "shop_title", "click_sum"))


# --- token lists by the other plan ----------------------------------------------

def _expanded_by_join(spark, d):
    ctx = Ctx(spark, d)
    labelled = PR.clean_and_label(ctx.raw())
    with_cf = PR.left_join_dimension(labelled, ctx.src("category_feature_src"), on=["level_one_category_name", "category_name"])
    specs = [("feature", TK.FEATURE_K), *((c, TK.PAIR_K) for c in TK.PAIR_COLUMNS)]
    # The stage is read for these columns only; the others need not travel through the joins.
    rows = with_cf.select("ds", "title_x", "lable_x", *[c for c, _ in specs])
    out = TK.topk_lists(PR.staged(rows, "labelled"), specs, ["ds"], map_tokens=0)
    names = [TK.FEATURE_NAMES, *([f"{c}_1", f"{c}_2"] for c in TK.PAIR_COLUMNS)]
    return out.select("ds", "title_x", "lable_x", *[F.col(f"{c}_topk")[i].alias(n) for (c, _), ns in zip(specs, names)
                                                    for i, n in enumerate(ns)])


query("expand_tokens_by_join", ORACLE["expand_tokens"])(_expanded_by_join)


# --- co-partitioned stages ------------------------------------------------------

def _bucketed(spark, d, last):
    ctx = Ctx(spark, d)
    texts = B.described(ctx.src("llm_src"), ctx.src("ssr_src"))
    sources = [ctx.src("label_src"), ctx.src("dua_src"), texts, ctx.src("ici_src")]
    # One task reads a bucket of each table, so their number follows the session's partitions.
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with B.bucket_tables(spark) as write:
        tables = [write(df, t, buckets) for df, t in zip(sources, ("title", "item_title", "item_title", "title"))]
        titled = last(B.merge_bucketed(*tables))
        rest = last(B.merge_bucketed(*B.untitled(*sources), null_equal=True))
        return write_scratch(titled.unionByName(rest), "merged")      # before the tables go


query("left_join_chain_bucketed", ORACLE["left_join_chain"])(lambda spark, d: _bucketed(spark, d, lambda raw: raw))
query("clean_items_bucketed", ORACLE["clean_items"])(
    lambda spark, d: _bucketed(spark, d, lambda raw: B.first_rows(raw, PR.DEDUP_ORDER)))


# --- counts that come with the write -----------------------------------------------

def _observed_counts(spark, d):
    counts = C.CleaningCounts(distinct=True)
    with skewed_joins_split(spark):
        FI.write_stage(counts.cleaned(Ctx(spark, d).raw(), order=PR.DEDUP_ORDER), scratch_path(spark, "cleaned"))
    rows = [(i, step, n) for i, (step, n) in enumerate(counts.rows.items())]
    return spark.createDataFrame(rows, "step_no int, step string, rows long")


query("step_counts_observed", ORACLE["step_counts"])(_observed_counts)


def _observed_json(spark, d):
    """Unparsable descriptions, counted while the items are cleaned."""
    ctx = Ctx(spark, d)
    raw = M.label_with_items(ctx.src("label_src"), ctx.src("dua_src"))
    texts = ctx.src("llm_src").select(F.col("item_title").alias("__t"), "llm_nor")
    raw = raw.join(texts, raw["title_x"] == F.col("__t"), "left").drop("__t")
    counts = C.CleaningCounts(json=["llm_nor"])
    write_scratch(counts.cleaned(raw, order=PR.DEDUP_ORDER[:11]), "cleaned")
    rows = counts.rows
    return spark.createDataFrame([(rows["input"], rows["corrupt:llm_nor"])], "rows long, n_corrupt long")


query("json_corrupt_observed",
      f"WITH {O.RAW_BASE} SELECT count(*) AS rows, count_if(llm_nor IS NOT NULL AND CASE WHEN json_valid(llm_nor) "
      "THEN json_type(llm_nor) <> 'OBJECT' ELSE true END) AS n_corrupt FROM raw_d1 r LEFT JOIN llm_src t ON r.title_x = t.item_title")(
    _observed_json)


# --- growing days ---------------------------------------------------------------

def _by_days(spark, d, write):
    """CLEAN through ``write`` in three steps: the early days with all labels
    the other way round, then the late days, then the early ones as they are."""
    clean = Ctx(spark, d).clean()
    early, late = clean.where(F.col("ds") <= "1995"), clean.where(F.col("ds") > "1995")
    write(early.withColumn("lable_x", 1 - F.col("lable_x")))
    write(late)
    write(early)
    return clean


def _day_counts(spark, d):
    """The stored label counts after days were added and replaced, and CLEAN."""
    stage = scratch_path(spark, "day-counts")
    clean = _by_days(spark, d, lambda part: MF.replace_days(CF.day_counts(part), stage, files_per_day=1))
    return MF.read_days(spark, stage, CF.day_counts(clean).schema), clean


query("label_pivot_by_days", ORACLE["label_pivot"])(lambda spark, d: CF.merged_counts(_day_counts(spark, d)[0]))
query("conflict_report_by_days", ORACLE["conflict_report"])(
    lambda spark, d: CF.pivot_report(CF.merged_counts(_day_counts(spark, d)[0])).withColumn("share", r6("share")))


def _counted_conflicts(spark, d):
    days, clean = _day_counts(spark, d)
    return CF.remove_counted_conflicts(clean, days).select(*EXPAND_VIEW)


query("remove_conflicts_by_days", ORACLE["remove_conflicts"])(_counted_conflicts)


def _nunique_sketched(spark, d):
    """Distinct counts from the days' stored sketches next to the exact ones."""
    stage = scratch_path(spark, "sketches")
    clean = _by_days(spark, d, lambda part: MF.replace_days(P.distinct_sketches(part), stage, files_per_day=1))
    found = P.sketched_nunique(MF.read_days(spark, stage, P.distinct_sketches(clean).schema))
    exact = P.profile_nunique(clean, [c for c in clean.columns if c != "ds"])
    off = F.abs(F.col("n_estimate") - F.col("n_distinct"))
    return exact.join(found, "column", "left").select(
        "column", "n_distinct", (off <= F.ceil(P.SKETCH_ERROR * F.col("n_distinct"))).alias("within_bound"))


query("profile_nunique_sketched",
      f"SELECT \"column\", n_distinct, true AS within_bound FROM ({ORACLE['profile_nunique']}) WHERE \"column\" <> 'ds'")(
    _nunique_sketched)


def _replaced_days(spark, d):
    """CLEAN read from a stage whose days were replaced one version after another."""
    stage = scratch_path(spark, "versions")
    clean = _by_days(spark, d, lambda part: MF.replace_days(part, stage))
    return MF.read_days(spark, stage, clean.schema).select(*EXPAND_VIEW)


query("stage_replaced_days", CLEAN_SQL + f"\nSELECT {', '.join(EXPAND_VIEW)} FROM clean")(_replaced_days)


# --- shuffle and split that any engine can state -----------------------------------

query("shuffle_rows_indexed",
      CLEAN_SQL + f"\nSELECT ds, title_x, lable_x, row_number() OVER (ORDER BY {keyed_sql(42, ['ds', 'title_x'])}) - 1 AS \"index\" "
      "FROM clean")(
    lambda spark, d: SP.shuffled(Ctx(spark, d).clean_once().select("ds", "title_x", "lable_x"), ["ds", "title_x"]))

query("hash_split_rows",
      CLEAN_SQL + ", b AS (SELECT ds, title_x, CAST('0x' || substr(" + keyed_sql(42, ["title_x"]) + ", 1, 8) AS BIGINT) % 10000 AS b "
      "FROM clean) SELECT ds, title_x, CASE WHEN b < 8000 THEN 'train' WHEN b < 9500 THEN 'valid' ELSE 'test' END AS split FROM b")(
    lambda spark, d: SP.keyed_split(Ctx(spark, d).clean_once().select("ds", "title_x"), "title_x", (0.8, 0.15, 0.05),
                                    ("train", "valid", "test")))