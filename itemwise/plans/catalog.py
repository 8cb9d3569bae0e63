"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the driver's tables (through the stand-ins), with an optional DuckDB
oracle SQL stating the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemwise.functions import labels as LB
from itemwise.operators import clean as C
from itemwise.operators import profile as P
from itemwise.operators.columns import col
from itemwise.plans import merge as M
from itemwise.plans import oracle as O
from itemwise.plans import prepare as PR
from itemwise.plans import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    """Round a computed double to 6 digits (both sides of the oracle do)."""
    return F.round(col(c) if isinstance(c, str) else c, 6)


class Ctx:
    """Lazily built stand-in tables and pipeline stages for one sf_dir."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def src(self, name: str) -> DataFrame:
        return self._get(name, lambda: S.standin(self.spark, self.sf_dir, name))

    def table(self, name: str) -> DataFrame:
        return self._get("t_" + name, lambda: S.table(self.spark, self.sf_dir, name))

    def raw_d1(self) -> DataFrame:
        return self._get("raw_d1", lambda: M.label_with_items(self.src("label_src"),
                                                              self.src("dua_src")))

    def raw(self) -> DataFrame:
        return self._get("raw", lambda: M.merge_sources(
            self.src("label_src"), self.src("dua_src"), self.src("llm_src"),
            self.src("ssr_src"), self.src("ici_src")))

    def first_rows(self) -> DataFrame:
        order = PR.DEDUP_ORDER
        return self._get("first", lambda: C.clean_items(self.raw(), order=order))

    def labelled(self, rule: str = "a", weekly_max=LB.RULE_A_WEEKLY_MAX) -> DataFrame:
        return self._get(f"lab_{rule}_{weekly_max}",
                         lambda: C.label_items(self.first_rows(), rule, weekly_max=weekly_max))

    def clean(self) -> DataFrame:
        return self._get("clean", lambda: PR.prepare_day_items(
            self.raw(), self.src("category_feature_src")))

    def clean_once(self) -> DataFrame:
        """CLEAN for a query that reads it once: not written as a stage, so
        that only the columns asked for are expanded."""
        return self._get("clean_once", lambda: PR.prepare_day_items(
            self.raw(), self.src("category_feature_src"), stage_clean=False))


LABEL_VIEW = ["ds", "title_x", "buy_num_x", "click_num_x", "weekly_order_cnt", "lable_x"]


def _label_query(rule, weekly_max):
    def fn(spark, sf_dir):
        return Ctx(spark, sf_dir).labelled(rule, weekly_max).select(*LABEL_VIEW)
    return fn


def _label_sql(rule, weekly_max):
    return (f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled(rule, weekly_max)}\n"
            f"SELECT {', '.join(LABEL_VIEW)} FROM labelled")


# --- entry 1: joins and JSON -------------------------------------------------

query("left_join_item", f"WITH {O.RAW_BASE} SELECT * FROM raw_d1")(
    lambda spark, d: Ctx(spark, d).raw_d1())

query("left_join_dimension", f"WITH {O.RAW_BASE} SELECT * FROM llm_ssr")(
    lambda spark, d: M.descriptions_with_stats(Ctx(spark, d).src("llm_src"),
                                               Ctx(spark, d).src("ssr_src")))

query("left_join_chain", f"WITH {O.RAW_BASE} SELECT * FROM raw")(
    lambda spark, d: Ctx(spark, d).raw())

# --- entry 2: clean, label ---------------------------------------------------

query("clean_items", f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE} SELECT * FROM raw_first")(
    lambda spark, d: Ctx(spark, d).first_rows())

query("label_rule_a", _label_sql("a", 7))(_label_query("a", 7))
query("label_rule_a_no_weekly", _label_sql("a", None))(_label_query("a", None))
query("label_rule_b", _label_sql("b", None))(_label_query("b", None))

query("label_distribution",
      f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled('a', 7)}\n"
      "SELECT lable_x, count(*) AS rows FROM labelled GROUP BY lable_x")(
    lambda spark, d: P.label_distribution(Ctx(spark, d).labelled()))


# --- shared stand-ins on other driver tables ---------------------------------

def events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with payloads: error events carry a truncated object; the
    nested form wraps props under "outer" (view events under "other")."""
    e = S.table(spark, sf_dir, "events")
    bad = F.col("event_type") == "error"
    props = F.when(bad, F.substring("props", 1, 5)).otherwise(F.col("props"))
    nested = (F.when(F.col("event_type") == "view", F.concat(F.lit('{"other":'), "props", F.lit("}")))
               .when(bad, F.concat(F.lit('{"outer":'), F.substring("props", 1, 5)))
               .otherwise(F.concat(F.lit('{"outer":'), "props", F.lit("}"))))
    return e.select("event_id", "event_type", props.alias("props"), nested.alias("nested"))


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, score): purchases are positives, score = value / (value + 50)."""
    e = S.table(spark, sf_dir, "events")
    return e.select((F.col("event_type") == "purchase").cast("int").alias("label"),
                    (F.col("value") / (F.col("value") + 50.0)).alias("score"))


# --- JSON ---------------------------------------------------------------------

from itemwise.functions import jsoncols as J  # noqa: E402

query("json_flat_extract",
      f"WITH {O.EVENTS_JSON} SELECT event_id, props, "
      f"{O.json_field('props', '$.k')} AS k, {O.json_field('props', '$.category_first')} AS category_first "
      "FROM ev")(
    lambda spark, d: J.extract_flat(events_json(spark, d).select("event_id", "props"), "props",
                                    ["k", "category_first"]))

query("json_nested_extract",
      f"WITH {O.EVENTS_JSON} SELECT event_id, nested, "
      f"TRY_CAST({O.json_field('nested', '$.outer.k')} AS DOUBLE) AS nested_k, "
      f"{O.json_field('nested', '$.outer.unit')} AS nested_unit FROM ev")(
    lambda spark, d: J.extract_nested(events_json(spark, d).select("event_id", "nested"), "nested",
                                      "outer", [("k", "double"), ("unit", "string")]))

query("json_corrupt_count",
      f"WITH {O.EVENTS_JSON} SELECT count_if(props IS NOT NULL AND NOT json_valid(props)) "
      "AS n_corrupt, count(props) AS n_values FROM ev")(
    lambda spark, d: J.corrupt_count(events_json(spark, d), "props", ["k"]))

query("json_stats_extract",
      f"WITH {O.RAW_BASE} SELECT \"ranked_categories.category_name\" AS category_name, "
      f"{', '.join(O.stat_columns('s'))} FROM ssr_src s")(
    lambda spark, d: M.extract_stats(
        Ctx(spark, d).src("ssr_src")).withColumnRenamed("ranked_categories.category_name",
                                                        "category_name")
    .drop(*[f"ranked_categories.{c}" for c, _ in M.STAT_COLUMNS]))

# --- joins --------------------------------------------------------------------

from itemwise.operators import joins as JN  # noqa: E402
from itemwise.operators import columns as CO  # noqa: E402

SUFFIX_COLS = ("l.ds, l.title AS title_x, l.buy_num AS buy_num_x, l.click_num AS click_num_x, "
               "d.item_title, d.title AS title_y, d.buy_num AS buy_num_y, d.click_num AS click_num_y, "
               "d.coupons_share_url, d.goods_id, d.item_id, d.\"update\", d.row_num, d.item_id_temp, "
               + ", ".join("d." + c for c in O.D1_COLS))

query("suffix_join",
      f"WITH {O.RAW_BASE} SELECT {SUFFIX_COLS} FROM label_src l LEFT JOIN dua_src d "
      "ON l.ds IS NOT DISTINCT FROM d.ds AND l.title IS NOT DISTINCT FROM d.item_title")(
    lambda spark, d: JN.merge(Ctx(spark, d).src("label_src"), Ctx(spark, d).src("dua_src"),
                              on=["ds"], left_on=["title"], right_on=["item_title"]))


def _masked_keys(spark, d):
    c = S.table(spark, d, "customer")
    s = S.table(spark, d, "supplier")
    c = c.select(F.when(F.col("c_mktsegment") == "BUILDING", None).otherwise(F.col("c_custkey"))
                 .alias("key"), "c_name")
    s = s.select(F.when(F.col("s_suppkey") <= 3, None).otherwise(F.col("s_suppkey"))
                 .alias("key"), "s_name")
    return c, s


MASKED_SQL = """c AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS key,
                     c_name FROM customer),
s AS (SELECT CASE WHEN s_suppkey <= 3 THEN NULL ELSE s_suppkey END AS key, s_name FROM supplier)"""

query("nullsafe_left_join",
      f"WITH {MASKED_SQL} SELECT c.key, c.c_name, s.s_name FROM c LEFT JOIN s "
      "ON c.key IS NOT DISTINCT FROM s.key")(
    lambda spark, d: JN.nullsafe_left_join(*_masked_keys(spark, d), on=["key"]))

query("plain_left_join",
      f"WITH {MASKED_SQL} SELECT c.key, c.c_name, s.s_name FROM c LEFT JOIN s ON c.key = s.key")(
    lambda spark, d: JN.merge(*_masked_keys(spark, d), on=["key"], how="left", null_equal=False))

query("empty_source_left_join",
      f"WITH {O.RAW_BASE} SELECT l.ds, l.title AS title_x, l.buy_num AS buy_num_x, "
      "l.click_num AS click_num_x, " + ", ".join(
          f"CAST(NULL AS {'BIGINT' if c == 'weekly_order_cnt' else 'DOUBLE' if c in O.D1_COLS[5:] else 'VARCHAR'}) AS {c}"
          for c in O.D1_COLS) + " FROM label_src l")(
    lambda spark, d: M.label_with_items(
        Ctx(spark, d).src("label_src"),
        spark.createDataFrame([], Ctx(spark, d).src("dua_src").schema)))

CF_VIEW = LABEL_VIEW + ["level_one_category_name", "category_name", "tb_push", "tb_pay_money",
                        "tb_ctr", "tb_cvr"]

query("left_join_composite",
      f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled('a', 7)},\n{O.WITH_CF}\n"
      f"SELECT {', '.join(CF_VIEW)} FROM with_cf")(
    lambda spark, d: JN.left_join_dimension(Ctx(spark, d).labelled(),
                                            Ctx(spark, d).src("category_feature_src"),
                                            on=["level_one_category_name", "category_name"])
    .select(*CF_VIEW))

query("blacklist_anti",
      f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled('a', 7)}\n"
      f"SELECT {', '.join(LABEL_VIEW)}, category_name FROM labelled "
      "WHERE category_name IS NULL OR category_name NOT IN (SELECT category_name FROM blacklist_src)")(
    lambda spark, d: JN.remove_blacklisted(Ctx(spark, d).labelled(),
                                           Ctx(spark, d).src("blacklist_src"))
    .select(*LABEL_VIEW, "category_name"))

# --- filters ------------------------------------------------------------------

query("drop_null_key",
      f"WITH {O.RAW_BASE} SELECT * FROM raw_d1 WHERE category_name IS NOT NULL")(
    lambda spark, d: C.drop_null_key(Ctx(spark, d).raw_d1()))

query("exclude_single_buy",
      f"WITH {O.RAW_BASE} SELECT * FROM raw_d1 WHERE buy_num_x IS DISTINCT FROM 1")(
    lambda spark, d: Ctx(spark, d).raw_d1().where(LB.not_single_buy()))

query("tighten_negatives",
      f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled('a', 7)}\n"
      f"SELECT {', '.join(LABEL_VIEW)} FROM labelled "
      "WHERE lable_x IS DISTINCT FROM 0 OR weekly_order_cnt < 4")(
    lambda spark, d: C.tighten(Ctx(spark, d).labelled()).select(*LABEL_VIEW))

query("funnel_filter",
      f"WITH {O.RAW_BASE} SELECT * FROM raw_d1 WHERE click_num_x > buy_num_x AND buy_num_x > 0")(
    lambda spark, d: C.funnel_filter(Ctx(spark, d).raw_d1(), push="click_num_x",
                                     click="buy_num_x"))

# --- dedup on documents (exact and key copies) --------------------------------

query("distinct_rows",
      "SELECT DISTINCT text, lang, source, n_chars FROM documents")(
    lambda spark, d: C.distinct_rows(S.table(spark, d, "documents")
                                     .select("text", "lang", "source", "n_chars")))

query("dedup_keep_first",
      "SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER "
      "(PARTITION BY text ORDER BY n_chars DESC NULLS FIRST, doc_id) AS rn FROM documents) "
      "WHERE rn = 1")(
    lambda spark, d: C.dedup_keep_first(S.table(spark, d, "documents"), ["text"],
                                        [("n_chars", False), ("doc_id", True)]))

# --- tokens -------------------------------------------------------------------

from itemwise.operators import tokens as TK  # noqa: E402

DOC_TOK = ("WITH t AS (SELECT lang, unnest(string_split(text, ' ')) AS token FROM documents "
           "WHERE text IS NOT NULL), f AS (SELECT lang, token, count(*) AS n FROM t GROUP BY lang, token)")


def _docs(spark, d):
    return S.table(spark, d, "documents").select("doc_id", "lang", "text")


query("split_tokens",
      "SELECT doc_id, len(string_split(text, ' ')) AS n_tokens, "
      "string_split(text, ' ')[1] AS first_token, string_split(text, ' ')[-1] AS last_token "
      "FROM documents")(
    lambda spark, d: _docs(spark, d).select(
        "doc_id", F.size(TK.split_tokens("text", " ")).alias("n_tokens"),
        TK.split_tokens("text", " ")[0].alias("first_token"),
        F.element_at(TK.split_tokens("text", " "), -1).alias("last_token")))

query("token_frequency", DOC_TOK + " SELECT lang, token, n FROM f")(
    lambda spark, d: TK.token_frequency(_docs(spark, d), "text", ["lang"], " "))

query("top_tokens",
      DOC_TOK + " SELECT lang, token, n, rank FROM (SELECT *, row_number() OVER "
      "(PARTITION BY lang ORDER BY n DESC, token) AS rank FROM f) WHERE rank <= 20")(
    lambda spark, d: TK.top_tokens(TK.token_frequency(_docs(spark, d), "text", ["lang"], " "),
                                   20, ["lang"]))

TOP6 = [f"top{i}" for i in range(1, 7)]
TOP2 = ["text_1", "text_2"]

query("topk_tokens_6", O.docs_topk(6, TOP6))(
    lambda spark, d: TK.expand_list(_docs(spark, d), "text", 6, TOP6, ["lang"], " "))

query("topk_tokens_2", O.docs_topk(2, TOP2))(
    lambda spark, d: TK.expand_list(_docs(spark, d), "text", 2, TOP2, ["lang"], " "))

query("topk_tokens_null_group",
      O.docs_topk(6, TOP6).replace("FROM documents", "FROM nulled", 2).replace(
          "WITH ", "WITH nulled AS (SELECT doc_id, nullif(lang, 'es') AS lang, text FROM documents),\n", 1)
      .replace("documents s", "nulled s"))(
    lambda spark, d: TK.expand_list(
        _docs(spark, d).withColumn("lang", F.nullif("lang", F.lit("es"))), "text", 6, TOP6, ["lang"], " "))

query("token_counts",
      "SELECT doc_id, CASE WHEN source = 'src1' THEN 0 ELSE len(string_split(text, ' ')) END AS n_tokens "
      "FROM documents")(
    lambda spark, d: S.table(spark, d, "documents").select(
        "doc_id", F.when(F.col("source") != "src1", F.col("text")).alias("text"))
    .select("doc_id", TK.token_count("text", " ").alias("n_tokens")))

query("split_length_histogram",
      "SELECT len(string_split(text, ' ')) AS n_tokens, count(*) AS rows FROM documents "
      "WHERE text IS NOT NULL GROUP BY 1")(
    lambda spark, d: TK.split_length_histogram(_docs(spark, d), "text", " "))

query("split_length_stats",
      "WITH h AS (SELECT len(string_split(text, ' ')) AS n_tokens, count(*) AS rows FROM documents "
      "WHERE text IS NOT NULL GROUP BY 1) SELECT (SELECT max(n_tokens) FROM h) AS max_tokens, "
      "n_tokens AS mode_tokens, rows AS mode_rows FROM h ORDER BY rows DESC, n_tokens LIMIT 1")(
    lambda spark, d: TK.split_length_stats(_docs(spark, d), "text", " "))

CLEAN_SQL = f"WITH {O.clean_ctes('a')}"


def _repeated_categories(spark, d):
    """CLEAN with a category table that lists some categories twice, so that
    (day, title) repeats."""
    ctx = Ctx(spark, d)
    cf = ctx.src("category_feature_src")
    twice = cf.where("tb_ctr < 0.3").withColumn("tb_push", F.col("tb_push") + 1000)
    return PR.prepare_day_items(ctx.raw(), cf.unionByName(twice)).select(*EXPAND_VIEW, "tb_push")


query("expand_tokens_repeated", f"WITH {O.clean_ctes_repeated()}\n"
      "SELECT ds, title_x, lable_x, feature1, feature2, feature3, feature4, feature5, feature6, scenario_1, "
      "scenario_2, brand_real_1, brand_real_2, audience_1, audience_2, tb_push FROM clean")(_repeated_categories)
EXPAND_VIEW = ["ds", "title_x", "lable_x"] + TK.FEATURE_NAMES + [
    "scenario_1", "scenario_2", "brand_real_1", "brand_real_2", "audience_1", "audience_2"]

query("expand_tokens", CLEAN_SQL + f"\nSELECT {', '.join(EXPAND_VIEW)} FROM clean")(
    lambda spark, d: Ctx(spark, d).clean_once().select(*EXPAND_VIEW))

query("item_token_frequency",
      f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled('a', 7)},\n{O.WITH_CF}\n"
      "SELECT ds, token, count(*) AS n FROM (SELECT ds, unnest(string_split(feature, ';')) AS token "
      "FROM with_cf WHERE feature IS NOT NULL) GROUP BY ds, token")(
    lambda spark, d: TK.token_frequency(
        JN.left_join_dimension(Ctx(spark, d).labelled(), Ctx(spark, d).src("category_feature_src"),
                               on=["level_one_category_name", "category_name"]),
        "feature", ["ds"]))

# --- conflicts ----------------------------------------------------------------

from itemwise.operators import conflicts as CF  # noqa: E402

query("label_pivot", CLEAN_SQL + f",\n{O.CONFLICTS}\nSELECT title_x, n0, n1 FROM label_counts")(
    lambda spark, d: CF.label_pivot(Ctx(spark, d).clean_once()))

query("conflict_report",
      CLEAN_SQL + f",\n{O.CONFLICTS}\nSELECT count_if(n0 > 0 AND n1 > 0) AS n_conflicting, "
      "count(*) AS n_titles, round(CAST(count_if(n0 > 0 AND n1 > 0) AS DOUBLE) / count(*), 6) "
      "AS share FROM label_counts")(
    lambda spark, d: CF.conflict_report(Ctx(spark, d).clean_once()).withColumn("share", r6("share")))

query("remove_conflicts", CLEAN_SQL + f",\n{O.CONFLICTS}\nSELECT {', '.join(EXPAND_VIEW)} FROM train_all")(
    lambda spark, d: PR.training_set(Ctx(spark, d).clean_once()).select(*EXPAND_VIEW))


# --- stages for encoding / training ------------------------------------------

from itemwise.operators import encode as EN  # noqa: E402
from itemwise.operators import evaluate as EV  # noqa: E402
from itemwise.operators import model as MD  # noqa: E402
from itemwise.operators import sample as SP  # noqa: E402
from itemwise.plans import train as TR  # noqa: E402
from itemwise.session import scratch_path  # noqa: E402
from itemwise.sources import dated as DT  # noqa: E402
from itemwise.sources import files as FI  # noqa: E402


def _train_all(ctx: Ctx) -> DataFrame:
    return ctx._get("train_all", lambda: PR.training_set(ctx.clean()))


def _train_all_once(ctx: Ctx) -> DataFrame:
    return ctx._get("train_all_once", lambda: PR.training_set(ctx.clean_once()))


def _split(ctx: Ctx):
    return ctx._get("split", lambda: TR.training_inputs(_train_all(ctx)))


def _encoded(ctx: Ctx):
    return ctx._get("encoded", lambda: TR.fit_and_encode(*_split(ctx)))


# Where this process has saved the model of an input: (path, history).
_FITTED: dict[tuple, tuple[str, list]] = {}


def _fitted(ctx: Ctx, drop: tuple[str, ...] = ()):
    """The model of all rounds that the library's parameters ask for, and its
    history; fitted once for each input and session, like a saved model."""
    key = (ctx.spark.sparkContext.applicationId, ctx.sf_dir, drop)
    if key not in _FITTED:
        tr, te, _ = _encoded(ctx)
        model, history = TR.train_model(CO.drop_tolerant(tr, drop), CO.drop_tolerant(te, drop))
        path = scratch_path(ctx.spark, "model")
        MD.save_model(model, path)
        _FITTED[key] = (path, history)
    return _FITTED[key]


def _model(ctx: Ctx):
    return MD.load_model(_fitted(ctx)[0])


TRAIN_SQL = f"WITH {O.train_ctes(TR.CUT)}"

# --- profiles -----------------------------------------------------------------

query("profile_nunique",
      CLEAN_SQL + ", v AS (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM clean)\nSELECT name AS \"column\", "
      "count(DISTINCT value) AS n_distinct FROM v UNPIVOT INCLUDE NULLS (value FOR name IN (COLUMNS(*))) GROUP BY name")(
    lambda spark, d: P.profile_nunique(Ctx(spark, d).clean()))

query("distinct_with_null",
      f"WITH {O.RAW_BASE} SELECT count(DISTINCT category_second) + "
      "coalesce(max(CAST(category_second IS NULL AS INTEGER)), 0) AS n_unique FROM raw")(
    lambda spark, d: P.distinct_with_null(Ctx(spark, d).raw(), "category_second"))

query("equal_width_histogram",
      f"WITH {O.RAW_BASE}, v AS (SELECT CAST(weekly_order_cnt AS DOUBLE) AS x FROM raw_d1 "
      "WHERE weekly_order_cnt IS NOT NULL), m AS (SELECT min(x) AS lo, max(x) AS hi FROM v), "
      "b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 1000.0)), 999) "
      "END AS INTEGER) AS bin, lo, hi FROM v, m) "
      "SELECT bin, round(lo + bin * ((hi - lo) / 1000.0), 6) AS lower, "
      "round(lo + (bin + 1) * ((hi - lo) / 1000.0), 6) AS upper, count(*) AS rows "
      "FROM b GROUP BY bin, lo, hi")(
    lambda spark, d: P.equal_width_histogram(Ctx(spark, d).raw_d1(), "weekly_order_cnt", 1000)
    .withColumn("lower", r6("lower")).withColumn("upper", r6("upper")))

query("conditional_counts",
      f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled('a', 7)}\n"
      "SELECT count_if(lable_x = 1) AS n_positive, count_if(click_num_x <= 7) AS n_low_click, "
      "count_if(lable_x = 0) AS n_negative, "
      "count_if(coalesce(category_second, 'Unknown') = 'Unknown') AS n_unknown_category FROM labelled")(
    lambda spark, d: P.conditional_counts(
        EN.fill_unknown(Ctx(spark, d).labelled(), ["category_second"]),
        {"n_positive": F.col("lable_x") == 1, "n_low_click": F.col("click_num_x") <= 7,
         "n_negative": F.col("lable_x") == 0,
         "n_unknown_category": F.col("category_second") == "Unknown"}))

query("step_counts",
      f"WITH {O.RAW_BASE},\n{O.CLEAN_BASE},\n{O.labelled('a', 7)}\n"
      "SELECT 0 AS step_no, 'input' AS step, count(*) AS rows FROM raw UNION ALL "
      "SELECT 1, 'distinct', count(*) FROM raw_distinct UNION ALL "
      "SELECT 2, 'non_null_category', count(*) FROM raw_nn UNION ALL "
      "SELECT 3, 'one_per_title', count(*) FROM raw_first UNION ALL "
      "SELECT 4, 'not_single_buy', count(*) FROM raw_first WHERE buy_num_x IS DISTINCT FROM 1 UNION ALL "
      "SELECT 5, 'labelled', count(*) FROM labelled")(
    lambda spark, d: C.step_counts(Ctx(spark, d).raw(), order=PR.DEDUP_ORDER))

query("class_balance",
      CLEAN_SQL + f",\n{O.CONFLICTS}\nSELECT CASE WHEN ds <= '{TR.CUT}' THEN 'train' ELSE 'test' END "
      "AS split, count(*) AS rows, count_if(lable_x = 1) AS positives, count_if(lable_x = 0) AS negatives, "
      "round(CAST(count_if(lable_x = 1) AS DOUBLE) / count(*), 6) AS positive_share FROM train_all GROUP BY 1")(
    lambda spark, d: P.class_balance(SP.time_split(_train_all_once(Ctx(spark, d)), TR.CUT), by=["split"])
    .withColumn("positive_share", r6("positive_share")))

query("class_weight",
      TRAIN_SQL + ", c AS (SELECT lable_x AS label, count(*) AS rows FROM tr GROUP BY lable_x), "
      "t AS (SELECT sum(rows) FILTER (WHERE label = 1) AS p, sum(rows) FILTER (WHERE label = 0) AS n FROM c) "
      "SELECT label, rows, round(CASE WHEN label = 1 AND p < n THEN n / p "
      "WHEN label = 0 AND n < p THEN p / n ELSE 1.0 END, 6) AS weight FROM c, t")(
    lambda spark, d: MD.class_weights(TR.training_inputs(_train_all_once(Ctx(spark, d)))[0]).withColumn("weight", r6("weight")))

# --- schema operators ---------------------------------------------------------

STAT_KEPT = [n for c, _ in M.STAT_COLUMNS for n in
             [f"{c}_{f}" for f, _ in J.STAT_FIELDS] if n not in M.STAT_DROP]

query("drop_strict", f"WITH {O.RAW_BASE} SELECT * EXCLUDE ({', '.join(STAT_KEPT)}) FROM raw")(
    lambda spark, d: CO.drop_strict(Ctx(spark, d).raw(), STAT_KEPT))

query("drop_tolerant",
      CLEAN_SQL + f"\nSELECT * EXCLUDE ({', '.join(c for c in MD.EXCLUDED if c in ('title_x', 'pricejson_update_time', 'lable_x', 'click_num_x', 'buy_num_x', 'obj_scenario', 'time_scenario', 'dep_scenario', 'subj_scenario', 'brand_quality', 'category', 'ici_card', 'ici'))}) FROM clean")(
    lambda spark, d: CO.drop_tolerant(Ctx(spark, d).clean_once(), MD.EXCLUDED))

query("select_ordered",
      CLEAN_SQL + f"\nSELECT {', '.join(SP.SAMPLE_COLUMNS)} FROM clean")(
    lambda spark, d: CO.select_ordered(Ctx(spark, d).clean_once(), SP.SAMPLE_COLUMNS))

query("column_coverage",
      f"WITH {O.RAW_BASE}, l AS (" + " UNION ALL ".join(
          f"SELECT '{c}' AS \"column\", count({c}) AS non_null_left FROM raw_d1"
          for c in ["ds", "title_x", "buy_num_x", "click_num_x"] + O.D1_COLS)
      + "), r AS (" + " UNION ALL ".join(
          f"SELECT '{c}' AS \"column\", count({O.qi(c)}) AS non_null_right FROM dua_src"
          for c in ["ds", "item_title", "title", "buy_num", "click_num", "coupons_share_url", "goods_id",
                    "item_id", "update", "row_num", "item_id_temp"] + O.D1_COLS)
      + ") SELECT coalesce(l.\"column\", r.\"column\") AS \"column\", l.non_null_left IS NOT NULL AS in_left, "
      "r.non_null_right IS NOT NULL AS in_right, l.non_null_left, r.non_null_right "
      "FROM l FULL JOIN r ON l.\"column\" = r.\"column\"")(
    lambda spark, d: CO.column_coverage(Ctx(spark, d).raw_d1(), Ctx(spark, d).src("dua_src")))

# --- encoding -----------------------------------------------------------------

query("replace_sentinel",
      CLEAN_SQL + "\nSELECT ds, title_x, lable_x, " + ", ".join(
          f"coalesce({c}, 'Unknown') AS {c}" for c in EN.TOKEN_COLUMNS) + " FROM clean")(
    lambda spark, d: EN.replace_sentinel(Ctx(spark, d).clean_once())
    .select("ds", "title_x", "lable_x", *EN.TOKEN_COLUMNS))

query("fill_unknown",
      CLEAN_SQL + "\nSELECT ds, title_x, " + ", ".join(
          f"coalesce({c}, 'Unknown') AS {c}" for c in EN.FILL_BEFORE_ENCODE_SCORE) + " FROM clean")(
    lambda spark, d: EN.fill_unknown(Ctx(spark, d).clean_once(), EN.FILL_BEFORE_ENCODE_SCORE)
    .select("ds", "title_x", *EN.FILL_BEFORE_ENCODE_SCORE))

def _vocab_roundtrip(spark, d):
    path = scratch_path(spark, "vocab")
    # The codes are not read here, so neither CLEAN nor the encoded sets need to be written.
    split = TR.training_inputs(_train_all_once(Ctx(spark, d)))
    FI.save_vocab(TR.fit_and_encode(*split, stage_encoded=False)[2], path)
    return FI.load_vocab(spark, path)


query("ordinal_vocab", TRAIN_SQL + "\nSELECT \"column\", value, code FROM vocab")(_vocab_roundtrip)

ENC_VIEW = ["ds", "title_x", "lable_x"] + EN.FIT_COLUMNS


def _encode_all(spark, d):
    tr, te, _ = _encoded(Ctx(spark, d))
    return tr.unionByName(te).select(*ENC_VIEW)


query("ordinal_encode", TRAIN_SQL + "\n" + O.encoded_select("filled"))(_encode_all)

query("ordinal_encode_shared",
      TRAIN_SQL + ", enc AS (" + O.encoded_select("filled") + ") "
      "SELECT ds, title_x, category_first, category_second FROM enc")(
    lambda spark, d: _encode_all(spark, d).select("ds", "title_x", "category_first",
                                                  "category_second"))

# --- sampling and splits ------------------------------------------------------

query("balanced_sample",
      CLEAN_SQL + f",\n{O.CONFLICTS}\nSELECT {', '.join(SP.SAMPLE_COLUMNS)} FROM (SELECT *, "
      f"row_number() OVER (PARTITION BY lable_x ORDER BY {', '.join(SP.SAMPLE_COLUMNS)}) AS rn "
      f"FROM train_all WHERE {' AND '.join(c + ' IS NOT NULL' for c in SP.SAMPLE_COLUMNS)}) "
      "WHERE rn <= 1000")(
    lambda spark, d: SP.balanced_sample(_train_all_once(Ctx(spark, d)), 1000))

query("time_split",
      CLEAN_SQL + f"\nSELECT ds, title_x, lable_x, CASE WHEN ds <= '{TR.CUT}' THEN 'train' "
      "ELSE 'test' END AS split FROM clean")(
    lambda spark, d: SP.time_split(Ctx(spark, d).clean_once(), TR.CUT).select("ds", "title_x", "lable_x",
                                                                         "split"))

def _three_splits(spark, d):
    split = SP.three_way_split(Ctx(spark, d).clean_once(), "title_x")
    each = split.groupBy("title_x").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("split").alias("s"),
                                        F.max(F.col("split").isin("train", "valid", "test")).alias("known"))
    return each.agg(F.sum("n").alias("rows"), F.count_if(F.col("s") > 1).alias("titles_in_two"),
                    F.min("known").alias("all_named"))


query("hash_split", CLEAN_SQL + "\nSELECT CAST(count(*) AS BIGINT) AS rows, 0 AS titles_in_two, "
      "true AS all_named FROM clean")(_three_splits)

query("shuffle_rows", CLEAN_SQL + "\nSELECT ds, title_x, lable_x FROM clean")(
    lambda spark, d: SP.shuffle_rows(Ctx(spark, d).clean_once().select("ds", "title_x", "lable_x")))

# --- evaluation on event scores -------------------------------------------------

EVAL = f"WITH {O.EVENT_SCORES}, g AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM scored GROUP BY score)"

query("auc_exact",
      EVAL + ", r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
      "AND 1 PRECEDING), 0) AS neg_below FROM g) SELECT round(sum(pos * (neg_below + 0.5 * neg)) / "
      "(sum(pos) * sum(neg)), 6) AS auc FROM r")(
    lambda spark, d: EV.auc(event_scores(spark, d)).withColumn("auc", r6("auc")))

query("log_loss",
      f"WITH {O.EVENT_SCORES}, c AS (SELECT label, least(greatest(score, {EV.LOGLOSS_EPS!r}), "
      f"1 - {EV.LOGLOSS_EPS!r}) AS p FROM scored) SELECT round(avg(-(label * ln(p) + (1 - label) * "
      "ln(1 - p))), 6) AS log_loss FROM c")(
    lambda spark, d: EV.log_loss(event_scores(spark, d)).withColumn("log_loss", r6("log_loss")))

THRESH = "thresholds AS (SELECT unnest([" + ", ".join(repr(t) for t in EV.THRESHOLDS) + "]::DOUBLE[]) AS threshold)"
CONF = (EVAL + ", " + THRESH + ", c AS (SELECT t.threshold, "
        "CAST(sum(CASE WHEN g.score > t.threshold THEN g.pos ELSE 0 END) AS BIGINT) AS tp, "
        "CAST(sum(CASE WHEN g.score > t.threshold THEN g.neg ELSE 0 END) AS BIGINT) AS fp, "
        "CAST(sum(g.pos) AS BIGINT) AS P, CAST(sum(g.neg) AS BIGINT) AS N FROM thresholds t, g GROUP BY t.threshold), "
        "cc AS (SELECT threshold, tp, fp, P - tp AS fn, N - fp AS tn FROM c)")


def _ratio(a, b):
    return f"round(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END, 6)"


query("binary_metrics",
      CONF.replace("unnest([" + ", ".join(repr(t) for t in EV.THRESHOLDS) + "]", "unnest([0.5]")
      + f" SELECT threshold, {_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'tp + fn')} AS recall, "
      f"{_ratio('2 * tp', '2 * tp + fp + fn')} AS f1, {_ratio('tp + tn', 'tp + fp + fn + tn')} AS accuracy FROM cc")(
    lambda spark, d: EV.binary_metrics(event_scores(spark, d))
    .select("threshold", *[r6(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")]))

SWEEP_SQL = (CONF + " SELECT threshold, 1 AS class, tp, fp, "
             f"{_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'tp + fn')} AS recall, "
             f"{_ratio('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS support FROM cc UNION ALL "
             "SELECT threshold, 0, tn, fn, "
             f"{_ratio('tn', 'tn + fn')}, {_ratio('tn', 'tn + fp')}, "
             f"{_ratio('2 * tn', '2 * tn + fn + fp')}, tn + fp FROM cc")

query("threshold_sweep", SWEEP_SQL)(
    lambda spark, d: EV.threshold_sweep(event_scores(spark, d))
    .select("threshold", "class", "tp", "fp", *[r6(c).alias(c) for c in ("precision", "recall", "f1")],
            "support"))

query("classification_report",
      CONF + ", s AS (SELECT threshold, "
      "CASE WHEN tn + fn = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fn) END AS p0, "
      "CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END AS r0, "
      "CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2.0 * tn / (2 * tn + fn + fp) END AS f0, tn + fp AS s0, "
      "CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p1, "
      "CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS r1, "
      "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS s1, "
      "tp + tn AS ok, tp + fp + fn + tn AS n FROM cc) "
      "SELECT threshold, '0' AS row, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM s UNION ALL "
      "SELECT threshold, '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM s UNION ALL "
      "SELECT threshold, 'accuracy', NULL, NULL, round(CAST(ok AS DOUBLE) / n, 6), n FROM s UNION ALL "
      "SELECT threshold, 'macro avg', round((p0 + p1) / 2.0, 6), round((r0 + r1) / 2.0, 6), round((f0 + f1) / 2.0, 6), n FROM s UNION ALL "
      "SELECT threshold, 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6), "
      "round((f0 * s0 + f1 * s1) / n, 6), n FROM s")(
    lambda spark, d: EV.classification_report(event_scores(spark, d))
    .select("threshold", "row", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support"))

query("roc_curve",
      EVAL + ", r AS (SELECT score, pos, neg, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, "
      "row_number() OVER w - 1 AS i, lead(pos) OVER w AS np, lead(neg) OVER w AS nn FROM g "
      "WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), "
      "pts AS (SELECT score, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps FROM r "
      "WHERE i = 0 OR np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT 'inf'::DOUBLE, 0, 0), "
      "t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g) "
      "SELECT score AS threshold, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr, tps, fps FROM pts, t")(
    lambda spark, d: EV.roc_curve(event_scores(spark, d))
    .withColumn("fpr", r6("fpr")).withColumn("tpr", r6("tpr")))

query("score_density",
      f"WITH {O.EVENT_SCORES}, st AS (SELECT label, count(*) AS n, stddev_samp(score) AS sd, "
      "min(score) AS lo, max(score) AS hi FROM scored GROUP BY label), "
      "st2 AS (SELECT *, sd * pow(n, -0.2) AS bw FROM st), "
      f"st3 AS (SELECT *, lo - {EV.DENSITY_CUT!r} * bw AS g0, (hi - lo + {2 * EV.DENSITY_CUT!r} * bw) / "
      f"{EV.DENSITY_GRID - 1} AS step FROM st2), "
      f"cnt AS (SELECT label, (floor(score / {EV.DENSITY_BIN!r}) + 0.5) * {EV.DENSITY_BIN!r} AS s, count(*) AS c "
      f"FROM scored GROUP BY label, floor(score / {EV.DENSITY_BIN!r})), "
      f"grid AS (SELECT label, n, bw, i AS point, g0 + i * step AS x FROM st3, range({EV.DENSITY_GRID}) t(i)) "
      "SELECT g.label, CAST(g.point AS INTEGER) AS point, round(g.x, 6) AS x, "
      "round(sum(c.c * exp(-0.5 * ((g.x - c.s) / g.bw) * ((g.x - c.s) / g.bw))) / "
      "(g.n * g.bw * sqrt(2 * pi())), 6) AS density FROM grid g JOIN cnt c ON g.label = c.label "
      "GROUP BY g.label, g.point, g.x, g.n, g.bw")(
    lambda spark, d: EV.score_density(event_scores(spark, d))
    .select("label", "point", r6("x").alias("x"), r6("density").alias("density")))

# --- sources and sinks (written under the shared checkpoint folder) -------------

from itemwise import schemas as SC  # noqa: E402


def _written_days(spark, d):
    """LABEL written as one folder per day with parquet files and a stray
    non-parquet file, as the daily export folders look."""
    root = scratch_path(spark, "dated")
    (Ctx(spark, d).src("label_src").repartition(4, "ds").write.mode("overwrite")
     .partitionBy("ds").parquet(root))
    jvm = spark._jvm
    stray = jvm.org.apache.hadoop.fs.Path(f"{root}/ds=1995/notes.txt")
    stray.getFileSystem(spark._jsc.hadoopConfiguration()).create(stray).close()
    return root


query("scan_dated_source", f"WITH {O.RAW_BASE} SELECT title, buy_num, click_num, ds FROM label_src")(
    lambda spark, d: DT.scan_dated(spark, _written_days(spark, d), "ds=", SC.LABEL))

query("scan_dated_days",
      f"WITH {O.RAW_BASE} SELECT title, buy_num, click_num, ds FROM label_src WHERE ds IN ('1996', '1999')")(
    lambda spark, d: DT.scan_dated(spark, _written_days(spark, d), "ds=", SC.LABEL, ["1996", "1999"]))


query("scan_missing_day",
      f"WITH {O.RAW_BASE} SELECT title, buy_num, click_num, ds FROM label_src WHERE ds = '1996'")(
    lambda spark, d: DT.scan_dated(spark, _written_days(spark, d), "ds=", SC.LABEL, ["1996", "2050"]))


def _scan_all_sources(spark, d):
    """Rows and days that a scan of each daily source finds, one of them
    without any of the wanted days."""
    ctx, out = Ctx(spark, d), []
    for name, schema in (("label_src", SC.LABEL), ("dua_src", SC.DUA), ("llm_src", SC.LLM), ("ici_src", SC.ICI)):
        src = ctx.src(name)
        src = src if "ds" in src.columns else src.withColumn("ds", F.lit("1996"))
        root = scratch_path(spark, "dated")
        src.write.partitionBy("ds").parquet(root)
        for days in (["1996", "1997"], ["2050"]):
            found = DT.scan_dated(spark, root, "ds=", schema, days)
            out.append(found.agg(F.lit(name).alias("source"), F.lit(days[0]).alias("first_day"),
                                 F.count(F.lit(1)).alias("rows"), F.count_distinct("ds").alias("days")))
    return DT.union_by_name(out)


query("scan_all_sources",
      f"WITH {O.RAW_BASE}, u AS (SELECT 'label_src' AS source, ds FROM label_src UNION ALL SELECT 'dua_src', ds "
      "FROM dua_src UNION ALL SELECT 'llm_src', '1996' FROM llm_src UNION ALL SELECT 'ici_src', '1996' FROM ici_src) "
      "SELECT source, '1996' AS first_day, count(*) AS rows, count(DISTINCT ds) AS days FROM u "
      "WHERE ds IN ('1996', '1997') GROUP BY source UNION ALL SELECT DISTINCT source, '2050', 0, 0 FROM u")(
    _scan_all_sources)


def _union_by_name(spark, d):
    lab = Ctx(spark, d).src("label_src")
    early = lab.where(F.col("ds") <= "1997")
    late = lab.where(F.col("ds") > "1997").drop("click_num").withColumn("extra", F.lit("x"))
    return DT.union_by_name([early, late])


query("union_by_name",
      f"WITH {O.RAW_BASE} SELECT ds, title, buy_num, CASE WHEN ds <= '1997' THEN click_num END AS click_num, "
      "CASE WHEN ds > '1997' THEN 'x' END AS extra FROM label_src")(_union_by_name)


def _csv_roundtrip(spark, d):
    path = scratch_path(spark, "ssr-csv")
    FI.write_csv(Ctx(spark, d).src("ssr_src"), path)
    return FI.read_csv_dimension(spark, path, SC.SSR)


query("csv_dimension_scan", f"WITH {O.RAW_BASE} SELECT * FROM ssr_src")(_csv_roundtrip)


def _stage_roundtrip(spark, d):
    path = scratch_path(spark, "stage-clean")
    FI.write_stage(Ctx(spark, d).clean_once(), path)
    return FI.read_stage(spark, path).select(*EXPAND_VIEW)


query("stage_roundtrip", CLEAN_SQL + f"\nSELECT {', '.join(EXPAND_VIEW)} FROM clean")(_stage_roundtrip)


def _union_days(spark, d):
    path = scratch_path(spark, "stage-days")
    FI.write_stage(Ctx(spark, d).clean_once(), path)
    days = DT.union_days(FI.read_stage(spark, path), ["1996", "1997", "2003"])
    return P.label_distribution(days).withColumnRenamed("rows", "rows")


query("union_days",
      CLEAN_SQL + "\nSELECT lable_x, count(*) AS rows FROM clean WHERE ds IN ('1996', '1997') GROUP BY lable_x")(
    _union_days)


def _export_sample(spark, d):
    path = scratch_path(spark, "sample-csv")
    sample = SP.shuffle_rows(SP.balanced_sample(_train_all_once(Ctx(spark, d)), 1000))
    FI.write_csv(sample, path, single_file=True)
    return spark.read.options(**FI.CSV_OPTIONS).csv(path)


query("export_sample",
      CLEAN_SQL + f",\n{O.CONFLICTS}\nSELECT CAST(lable_x AS VARCHAR) AS lable_x, least(count(*), 1000) AS rows "
      f"FROM train_all WHERE {' AND '.join(c + ' IS NOT NULL' for c in SP.SAMPLE_COLUMNS)} GROUP BY lable_x")(
    lambda spark, d: _export_sample(spark, d).groupBy("lable_x").agg(F.count(F.lit(1)).alias("rows")))

# --- model ----------------------------------------------------------------------


def _scored(spark, d):
    ctx = Ctx(spark, d)
    return TR.scored_test(_model(ctx), _encoded(ctx)[1])


query("train_gbt")(
    lambda spark, d: MD.tree_nodes(spark, _model(Ctx(spark, d))).groupBy("tree")
    .agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("left") < 0).alias("leaves")))
query("feature_importance")(lambda spark, d: MD.feature_importance(_model(Ctx(spark, d)), top=20))
query("batch_score", TRAIN_SQL + f"\nSELECT ds, title_x, lable_x AS label, true AS is_probability FROM filled "
      f"WHERE ds > '{TR.CUT}'")(
    lambda spark, d: _scored(spark, d).select(
        "ds", "title_x", "label", F.col("score").between(0, 1).alias("is_probability")))
query("train_history")(
    lambda spark, d: spark.createDataFrame(_fitted(Ctx(spark, d))[1], "round int, auc double"))
query("model_auc")(lambda spark, d: EV.auc(_scored(spark, d)))


def _model_roundtrip(spark, d):
    """Scores of a model against those of its saved and loaded copy."""
    ctx = Ctx(spark, d)
    path = scratch_path(spark, "model")
    model, test = _model(ctx), _encoded(ctx)[1]
    MD.save_model(model, path)
    before = TR.scored_test(model, test).withColumnRenamed("score", "s1")
    after = TR.scored_test(MD.load_model(path), test).withColumnRenamed("score", "s2")
    both = before.join(after, ["ds", "title_x"], "full")
    return both.agg(F.count_if(~F.col("s1").eqNullSafe(F.col("s2"))).alias("n_differing"))


query("model_roundtrip", "SELECT 0 AS n_differing")(_model_roundtrip)

# --- streaming day loop ---------------------------------------------------------


def _streamed_clean(spark, d):
    from itemwise.streaming.daily import run_daily_clean
    ctx = Ctx(spark, d)
    raw_stage, clean_stage = scratch_path(spark, "raw-stage"), scratch_path(spark, "clean-stage")
    FI.write_stage(ctx.raw(), raw_stage)
    run_daily_clean(spark, raw_stage, clean_stage, ctx.src("category_feature_src"),
                    scratch_path(spark, "stream-ckpt"))
    return FI.read_stage(spark, clean_stage).select(*EXPAND_VIEW)


query("streaming_daily_clean", CLEAN_SQL + f"\nSELECT {', '.join(EXPAND_VIEW)} FROM clean")(
    _streamed_clean)


query("drop_by_pattern",
      f"WITH {O.RAW_BASE} SELECT * EXCLUDE ({', '.join(c for c in STAT_KEPT if c.endswith('_count_') or 'raw_' in c)}) FROM raw")(
    lambda spark, d: CO.drop_matching(Ctx(spark, d).raw(), suffixes=["_count_"], contains=["raw_"]))


GROUPS = {"price": ["zk_final_price", "reserve_price", "absent"], "browse": ["daily_browse_ratio", "daily_browse_cnt"],
          "other": ["ici"]}

query("drop_groups",
      f"WITH {O.RAW_BASE} SELECT * EXCLUDE (zk_final_price, reserve_price, daily_browse_ratio, daily_browse_cnt) FROM raw")(
    lambda spark, d: CO.drop_group(Ctx(spark, d).raw(), GROUPS, ["price", "browse"]))


def _score_later_days(spark, d):
    """Save model and vocabulary, load both, score the test days as step 3
    does - without the statistics, which its model has not seen either - and
    report the threshold sweep of those scores."""
    ctx = Ctx(spark, d)
    vpath = scratch_path(spark, "vocab")
    FI.save_vocab(_encoded(ctx)[2], vpath)
    model = MD.load_model(_fitted(ctx, tuple(STAT_KEPT))[0])
    test_days = TR.split_days(_train_all(ctx))[1]
    scores = TR.score_days(model, FI.load_vocab(spark, vpath), test_days, ctx.src("blacklist_src"), STAT_KEPT)
    return EV.threshold_sweep(scores)


query("score_later_days")(_score_later_days)


from itemwise.plans import catalog_stages  # noqa: E402, F401  (registers its queries)
