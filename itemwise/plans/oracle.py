"""DuckDB SQL that states each query's expected result independently of the
Spark code (used by the correctness check).  Stand-in tables come from the
same dialect-neutral SQL as the Spark side (``standins.duck_ctes``); every
operator on top of them is written here again in plain SQL."""

from __future__ import annotations

from itemwise.functions.jsoncols import LLM_KEYS, STAT_FIELDS
from itemwise.plans import merge as M
from itemwise.plans.standins import duck_ctes

DUCK_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR"}


def qi(name: str) -> str:
    return '"' + name + '"'


def json_field(expr: str, path: str) -> str:
    return (f"CASE WHEN json_valid({expr}) THEN CASE WHEN json_type({expr}) = 'OBJECT' "
            f"THEN json_extract_string({expr}, '{path}') END END")


def stat_columns(src: str = "q") -> list[str]:
    """The 32 kept statistics columns, extracted from the SSR JSON text."""
    out = []
    for c, outer in M.STAT_COLUMNS:
        x = f'{src}."ranked_categories.{c}"'
        for f, t in STAT_FIELDS:
            name = f"{c}_{f}"
            if name in M.STAT_DROP:
                continue
            v = json_field(x, f"$.{outer}.{f}")
            out.append(f"{v if t == 'string' else f'TRY_CAST({v} AS {DUCK_TYPES[t]})'} AS {name}")
    return out


D1_COLS = ["category_name", "level_one_category_name", "brand_name", "shop_title",
           "weekly_order_cnt", "zk_final_price", "reserve_price", "final_promotion_price",
           "daily_browse_ratio", "weekly_browse_ratio", "monthly_browse_ratio", "daily_browse_cnt"]

RAW_D1 = f"""raw_d1 AS (
  SELECT l.ds, l.title AS title_x, l.buy_num AS buy_num_x, l.click_num AS click_num_x,
         {', '.join('d.' + c for c in D1_COLS)}
  FROM label_src l LEFT JOIN dua_src d
    ON l.ds IS NOT DISTINCT FROM d.ds AND l.title IS NOT DISTINCT FROM d.item_title)"""

LLM_PARSED = f"""llm_parsed AS (
  SELECT item_title, llm_nor,
         {', '.join(json_field('llm_nor', '$.' + k) + ' AS ' + k for k in LLM_KEYS)}
  FROM llm_src)"""

LLM_SSR = """llm_ssr AS (
  SELECT p.item_title, p.scenario, p.category, p.feature, p.dep_scenario, p.time_scenario,
         p.obj_scenario, p.subj_scenario, p.audience, p.brand_quality, p.brand_real,
         p.category_second, p.category_first,
         s."ranked_categories.annual_voljson", s."ranked_categories.pricejson",
         s."ranked_categories.discountjson", s."ranked_categories.p_diffjson"
  FROM llm_parsed p LEFT JOIN ssr_src s
    ON p.category_second IS NOT DISTINCT FROM s."ranked_categories.category_name")"""

LLM_COLS = ["scenario", "category", "feature", "dep_scenario", "time_scenario", "obj_scenario",
            "subj_scenario", "audience", "brand_quality", "brand_real", "category_second",
            "category_first"]
ICI_COLS = ["click_sum", "buy_sum", "convert_rate", "ici_push_total", "gmv_sum",
            "commission_sum", "ici", "ici_card"]

RAW = f"""raw AS (
  SELECT r.*, {', '.join('q.' + c for c in LLM_COLS)},
         {', '.join(stat_columns('q'))},
         {', '.join('i.' + c for c in ICI_COLS)}
  FROM raw_d1 r
  LEFT JOIN llm_ssr q ON r.title_x IS NOT DISTINCT FROM q.item_title
  LEFT JOIN ici_src i ON r.title_x IS NOT DISTINCT FROM i.title)"""


def label_a_sql(weekly_max: int | None = 7) -> str:
    ratio = "CASE WHEN click_num_x = 0 THEN NULL ELSE CAST(buy_num_x AS DOUBLE) / click_num_x END"
    neg = "buy_num_x = 0 AND click_num_x >= 5"
    if weekly_max is not None:
        neg += f" AND weekly_order_cnt < {weekly_max}"
    return (f"CAST(CASE WHEN ({ratio}) >= 0.2 AND buy_num_x >= 2 AND click_num_x >= 3 THEN 1 "
            f"WHEN {neg} THEN 0 END AS INTEGER)")


LABEL_B = ("CAST(CASE WHEN buy_num_x >= 1 THEN 1 "
           "WHEN buy_num_x = 0 AND click_num_x >= 5 THEN 0 END AS INTEGER)")

FIRST_ORDER = ", ".join(c + " ASC NULLS FIRST" for c in (
    "buy_num_x", "category_name", "level_one_category_name", "brand_name", "shop_title", "weekly_order_cnt",
    "zk_final_price", "reserve_price", "final_promotion_price", "daily_browse_ratio", "weekly_browse_ratio",
    "monthly_browse_ratio", "daily_browse_cnt", "click_sum", "buy_sum", "convert_rate", "ici_push_total",
    "gmv_sum", "commission_sum", "ici", "ici_card"))
CLEAN_BASE = f"""raw_distinct AS (SELECT DISTINCT * FROM raw),
raw_nn AS (SELECT * FROM raw_distinct WHERE category_name IS NOT NULL),
raw_first AS (
  SELECT * EXCLUDE (__rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ds, title_x
                                 ORDER BY click_num_x DESC NULLS FIRST, {FIRST_ORDER}) AS __rn
    FROM raw_nn) WHERE __rn = 1)"""


def labelled(rule: str = "a", weekly_max: int | None = 7) -> str:
    expr = label_a_sql(weekly_max) if rule == "a" else LABEL_B
    return f"""labelled AS (
  SELECT * FROM (SELECT *, {expr} AS lable_x FROM raw_first
                 WHERE buy_num_x IS DISTINCT FROM 1) WHERE lable_x IS NOT NULL)"""


WITH_CF = """with_cf AS (
  SELECT l.*, c.tb_push, c.tb_pay_money, c.tb_ctr, c.tb_cvr
  FROM labelled l LEFT JOIN category_feature_src c
    ON l.level_one_category_name IS NOT DISTINCT FROM c.level_one_category_name
   AND l.category_name IS NOT DISTINCT FROM c.category_name)"""


def topk_ctes(src: str, column: str, k: int, names: list[str], keys: list[str],
              group: list[str], tag: str, delim: str = ";") -> tuple[str, str]:
    """CTEs ranking each list of ``src.column`` by per-group token frequency
    and a final CTE ``<tag>_out`` = src with the list replaced by ``names``."""
    gk = group + keys
    arr = f"string_split({column}, '{delim}')"
    on = " AND ".join(f"t.{g} IS NOT DISTINCT FROM f.{g}" for g in group) or "TRUE"
    on_back = " AND ".join(f"s.{c} IS NOT DISTINCT FROM w.{c}" for c in gk)
    picks = ", ".join(f"max(CASE WHEN rn = {i + 1} THEN tok END) AS {n}"
                      for i, n in enumerate(names))
    ctes = f"""{tag}_tok AS (
  SELECT {', '.join(gk)}, unnest({arr}) AS tok, unnest(range(len({arr}))) AS pos,
         len({arr}) AS len
  FROM {src} WHERE {column} IS NOT NULL),
{tag}_freq AS (SELECT {', '.join(group + ['tok'])}, count(*) AS n FROM {tag}_tok
               GROUP BY {', '.join(group + ['tok'])}),
{tag}_rank AS (
  SELECT {', '.join('t.' + c for c in gk)}, t.tok,
         row_number() OVER (PARTITION BY {', '.join('t.' + c for c in gk)}
                            ORDER BY CASE WHEN t.len > {k} THEN -f.n ELSE 0 END, t.pos) AS rn
  FROM {tag}_tok t JOIN {tag}_freq f ON {on} AND t.tok = f.tok),
{tag}_wide AS (SELECT {', '.join(gk)}, {picks} FROM {tag}_rank GROUP BY {', '.join(gk)}),
{tag}_out AS (
  SELECT s.* EXCLUDE ({column}), {', '.join('w.' + n for n in names)}
  FROM {src} s LEFT JOIN {tag}_wide w ON {on_back})"""
    return ctes, f"{tag}_out"


def clean_ctes(rule: str = "a") -> str:
    """Everything up to ``clean``: the expanded, labelled items of all days."""
    f_ctes, f_out = topk_ctes("with_cf", "feature", 6,
                              [f"feature{i}" for i in range(1, 7)], ["title_x"], ["ds"], "ft")
    parts = [f_ctes]
    src = f_out
    for c in ["scenario", "brand_real", "audience"]:
        ctes, out = topk_ctes(src, c, 2, [f"{c}_1", f"{c}_2"], ["title_x"], ["ds"], c)
        parts.append(ctes)
        src = out
    parts.append(f"clean AS (SELECT * FROM {src})")
    return ",\n".join([RAW_BASE, CLEAN_BASE, labelled(rule), WITH_CF] + parts)


def clean_ctes_repeated() -> str:
    """``clean`` where the category table lists some categories twice; every
    row has a number of its own, which the ranking uses as its key."""
    cf = """cf2 AS (SELECT * FROM category_feature_src UNION ALL
  SELECT * REPLACE (tb_push + 1000 AS tb_push) FROM category_feature_src WHERE tb_ctr < 0.3)"""
    numbered = """numbered AS (SELECT *, row_number() OVER () AS rid FROM with_cf)"""
    f_ctes, src = topk_ctes("numbered", "feature", 6, [f"feature{i}" for i in range(1, 7)], ["rid"], ["ds"], "ft")
    parts = [f_ctes]
    for c in ["scenario", "brand_real", "audience"]:
        ctes, src2 = topk_ctes(src, c, 2, [f"{c}_1", f"{c}_2"], ["rid"], ["ds"], c)
        parts.append(ctes)
        src = src2
    parts.append(f"clean AS (SELECT * FROM {src})")
    joined = WITH_CF.replace("category_feature_src", "cf2")
    return ",\n".join([RAW_BASE, CLEAN_BASE, labelled("a"), cf, joined, numbered] + parts)


RAW_BASE = ",\n".join([duck_ctes("label_src", "dua_src", "llm_src", "ici_src", "ssr_src",
                                 "category_feature_src", "blacklist_src"),
                       RAW_D1, LLM_PARSED, LLM_SSR, RAW])

CONFLICTS = """label_counts AS (
  SELECT title_x, count_if(lable_x = 0) AS n0, count_if(lable_x = 1) AS n1
  FROM clean WHERE title_x IS NOT NULL GROUP BY title_x),
conflicting AS (SELECT title_x FROM label_counts WHERE n0 > 0 AND n1 > 0),
train_all AS (
  SELECT * FROM clean c
  WHERE c.title_x IS NULL OR c.title_x NOT IN (SELECT title_x FROM conflicting))"""


def docs_topk(k: int, names: list[str]) -> str:
    ctes, out = topk_ctes("documents", "text", k, names, ["doc_id"], ["lang"], "dt", " ")
    return f"WITH {ctes}\nSELECT doc_id, lang, {', '.join(names)} FROM {out}"


EVENTS_JSON = """ev AS (
  SELECT event_id, event_type,
         CASE WHEN event_type = 'error' THEN substr(props, 1, 5) ELSE props END AS props,
         CASE WHEN event_type = 'view' THEN concat('{"other":', props, '}')
              WHEN event_type = 'error' THEN concat('{"outer":', substr(props, 1, 5))
              ELSE concat('{"outer":', props, '}') END AS nested
  FROM events)"""

EVENT_SCORES = """scored AS (
  SELECT CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS INTEGER) AS label,
         value / (value + 50.0) AS score
  FROM events)"""


def quote_list(cols: list[str]) -> str:
    return ", ".join(cols)


def train_ctes(cut: str = "1998") -> str:
    from itemwise.operators.encode import FILL_BEFORE_ENCODE_TRAIN, FIT_COLUMNS, TOKEN_COLUMNS
    repl = ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in TOKEN_COLUMNS)
    pairs = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM tr" for c in FIT_COLUMNS)
    fill = ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in FILL_BEFORE_ENCODE_TRAIN)
    return f"""{clean_ctes('a')},
{CONFLICTS},
tight AS (SELECT * FROM train_all WHERE lable_x IS DISTINCT FROM 0 OR weekly_order_cnt < 4),
repl AS (SELECT * REPLACE ({repl}) FROM tight),
tr AS (SELECT * FROM repl WHERE ds <= '{cut}'),
vocab AS (
  SELECT "column", value, dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS code
  FROM (SELECT DISTINCT "column", value FROM ({pairs}) WHERE value IS NOT NULL)),
filled AS (SELECT * REPLACE ({fill}) FROM repl)"""


def encoded_select(src: str = "filled") -> str:
    from itemwise.operators.encode import FIT_COLUMNS, SHARED_VOCAB
    cols, joins = [], []
    for i, c in enumerate(FIT_COLUMNS):
        v = SHARED_VOCAB.get(c, c)
        cols.append(f"coalesce(CAST(v{i}.code AS DOUBLE), -1.0) AS {c}")
        joins.append(f"LEFT JOIN vocab v{i} ON v{i}.\"column\" = '{v}' AND v{i}.value = f.{c}")
    return (f"SELECT f.ds, f.title_x, f.lable_x, {', '.join(cols)} FROM {src} f "
            + " ".join(joins))
