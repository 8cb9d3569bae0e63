"""Registered queries of the subpackage and their DuckDB SQL.

Each ``opN_`` query applies its operator to the whole of its table with the
production parameters; SQL is given where it can state the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemwise.llm import (chat, counts, decontaminate, lexical, merkle, minhash, pieces, quality, recompress, suffix, toxicity, warc,
                          wavelet)
from itemwise.session import write_scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file, at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_minhash", rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS p, w FROM d),
sh AS (SELECT doc_id, array_to_string(w[p + 1:p + 5], ' ') AS g, count(*) AS c FROM win GROUP BY ALL),
size AS (SELECT doc_id, sum(c) AS n FROM sh GROUP BY doc_id),
meet AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.c, b.c)) AS common
         FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM meet JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
          WHERE 10 * common >= 8 * (x.n + y.n - common)),
reach AS (SELECT doc_id, doc_id AS root FROM d UNION
          SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id),
class AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS members, doc_id = class_id AS kept
FROM class""")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), similarity=0.8)
    return found.select("doc_id", "class_id", "members", "kept")


_LIMITS = ", ".join(
    f"max(CASE WHEN metric = '{m}' THEN f END) AS max_{m}" for m in quality.SLACK)
_METRICS = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {m} AS v FROM m" for m in quality.SLACK)
_SLACKS = " ".join(f"WHEN '{m}' THEN {s}" for m, s in quality.SLACK.items())


def _fence_sql(name: str, source: str, keys: str) -> str:
    own = f"{keys}, " if keys else ""
    return f"""{name} AS (SELECT {own}metric, n, top(q3) + 3 * (top(q3) - top(q1))
    + CASE metric {_SLACKS} END AS f FROM (SELECT {own}metric, n, min(b) FILTER (WHERE 4 * u >= n) AS q1,
    min(b) FILTER (WHERE 4 * u >= 3 * n) AS q3 FROM (SELECT *, sum(c) OVER (PARTITION BY {own}metric) AS n,
    sum(c) OVER (PARTITION BY {own}metric ORDER BY b) AS u FROM {source}) GROUP BY {own}metric, n))"""


OP2_SQL = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(len(w) - 7)) AS p, w FROM d),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p + 1:p + 8], ' ')) AS c
          FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, p + unnest(range(8)) AS j FROM twice) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup
       FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
b AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[ 	-
]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS caps,
        CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN cov USING (doc_id)),
m AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        CAST(1000 * n_symbols // greatest(word_chars, 1) AS BIGINT) AS symbol_ratio,
        CAST(1000 * caps // greatest(word_chars, 1) AS BIGINT) AS capital_ratio,
        CAST(1000 * n_dup_lines // greatest(n_lines, 1) AS BIGINT) AS dup_line_ratio,
        CAST(100 * word_chars // greatest(n_words, 1) AS BIGINT) AS word_length FROM b),
s1 AS (SELECT lang, source, metric, b, count(*) AS c FROM (SELECT lang, source, metric,
        CASE WHEN v < 64 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)) END AS b
        FROM ({_METRICS})) GROUP BY ALL),
s2 AS (SELECT lang, metric, b, sum(c) AS c FROM s1 GROUP BY ALL),
s3 AS (SELECT metric, b, sum(c) AS c FROM s1 GROUP BY ALL),
{_fence_sql("f1", "s1", "lang, source")},
{_fence_sql("f2", "s2", "lang")},
{_fence_sql("f3", "s3", "")},
limits AS (SELECT lang, source, {_LIMITS} FROM (SELECT f1.lang, source, f1.metric,
        CASE WHEN f1.n >= 100 THEN f1.f WHEN f2.n >= 100 THEN f2.f ELSE f3.f END AS f
        FROM f1 JOIN f2 ON f1.lang IS NOT DISTINCT FROM f2.lang AND f1.metric = f2.metric
        JOIN f3 ON f1.metric = f3.metric) GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"{m} <= max_{m}" for m in quality.SLACK)} AS kept
FROM m JOIN limits ON m.lang IS NOT DISTINCT FROM limits.lang AND m.source IS NOT DISTINCT FROM limits.source"""
for _call in ("top(q3)", "top(q1)"):
    _q = _call[4:-1]
    OP2_SQL = OP2_SQL.replace(
        _call, f"(CASE WHEN {_q} < 64 THEN {_q} ELSE (({_q} % 32 + 33) << CAST(({_q} >> 5) - 1 AS INTEGER)) - 1 END)")


@query("op2_quality", OP2_SQL)
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = write_scratch(quality.measured(docs).drop("text"), "measured")
    return quality.judged(rows).select("doc_id", *quality.BASE, "kept")


@query("op3_pieces")
def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = pieces.decode(pieces.sample_encode(docs, model, key="doc_id", alpha=1.0, seed=7), model)
    return read.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"),
                       F.xxhash64("pieces").alias("pieces_hash"), F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


@query("op4_suffix_array")
def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix.suffix_dedup(table(spark, sf_dir, "documents"), width=400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_wavelet")
def op5_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = wavelet.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return wavelet.read_documents(manifest)


@query("op6_warc", """
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN lead END AS refers_to
FROM (SELECT *, octet_length(encode(h)) >= 1000 AND page_id <> lead AS again
      FROM (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead
            FROM pages))""")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(spark, warc.write_pages(table(spark, sf_dir, "pages")))


def _leak_sql() -> str:
    """Seeds as strings of the wanted words; the same comparison at each hit."""
    longest = max(map(len, decontaminate.MASKS))
    def seeds(source: str, place: str) -> str:
        return " UNION ALL ".join(
            f"SELECT *, '{k}:' || " + " || ' ' || ".join(
                f"w[{place} + {j + 1}]" for j, bit in enumerate(mask) if bit == "1")
            + f" AS h FROM {source} WHERE {place} + {len(mask)} <= len(w)"
            for k, mask in enumerate(decontaminate.MASKS))
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH i AS (SELECT item_id, {words} AS w FROM benchmark), d AS (SELECT doc_id, {words} AS w FROM documents),
ip AS (SELECT item_id, w, unnest(range(len(w) - {longest - 1})) AS p FROM i),
dp AS (SELECT doc_id, w, unnest(range(len(w) - {longest - 1})) AS q FROM d),
ih AS ({seeds("ip", "p")}), dh AS ({seeds("dp", "q")}),
hits AS (SELECT DISTINCT doc_id, item_id, q - p AS shift FROM dh JOIN ih USING (h)),
cmp AS (SELECT doc_id, item_id, shift, i.w AS iw, d.w AS dw FROM hits JOIN d USING (doc_id) JOIN i USING (item_id)),
eq AS (SELECT doc_id, item_id, len(iw) AS n, list_sum(list_transform(range(len(iw)), lambda j:
       CASE WHEN j + shift >= 0 AND iw[j + 1] = dw[j + shift + 1] THEN 1 ELSE 0 END)) AS m FROM cmp)
SELECT doc_id, item_id, CAST(max(n) AS BIGINT) AS item_words, CAST(max(m) AS BIGINT) AS matched
FROM eq WHERE m >= ceil(least(n, 20) * 80 / 100.0) GROUP BY doc_id, item_id"""


@query("op7_spaced_seeds", _leak_sql())
def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query("op8_chat", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '\|\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|<s>|</s>|\[TURN\]|\[:\]|\[/TURN\]|<\|image\|>|<\|audio\|>|<\|document\|>',
             '\\\0', 'g') AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped) + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 16 + length(role) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    read = chat.read_chats(chat.format_chats(turns.unionByName(extra)))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op9_recompression", rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(len(w) - 19)) AS p, w FROM d),
keyed AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 20], ' ') AS k FROM win),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r
          FROM keyed) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p + unnest(range(20)) AS j FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS j FROM d),
kept AS (SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY words.j) AS txt
         FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = recompress.substring_dedup(table(spark, sf_dir, "documents"), width=20, rounds=2)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where(part != 2)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select("doc_id", (part == 2).alias("held_out"), "score", "predicted")


@query("op11_stratified_search", r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM d),
tf AS (SELECT r, doc_id, len(ws) AS n, term, count(*) AS tf
       FROM (SELECT r, doc_id, ws, unnest(ws) AS term FROM w) GROUP BY ALL),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM w WHERE len(ws) > 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, size),
item AS (SELECT item_id, text, term, count(*) AS times FROM (SELECT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
    GROUP BY ALL),
part AS (SELECT item_id, text, r, doc_id, times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS s
         FROM item JOIN weight USING (term) JOIN tf USING (term), size),
total AS (SELECT item_id, text, r, doc_id, CAST(sum(s) AS BIGINT) AS score FROM part GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (
    PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM total WHERE score > 0)
WHERE rank <= 10""")
def op11_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10)


# Unsigned CRC-32 of a text of digits, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: CAST(ascii(c) AS BIGINT))), lambda a, c: list_reduce(list_prepend(xor(a, c), list_transform(range(8), lambda z: CAST(z AS BIGINT))),
    lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _merkle_sql() -> str:
    head = " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars")))
    level = """SELECT tree, lvl + 1 AS lvl, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h, (n + 2) // 3 AS n
               FROM {0} WHERE n > 1 GROUP BY tree, lvl, pos // 3, n"""
    kids = "SELECT tree, lvl, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM {0} WHERE n > 1 GROUP BY ALL"
    fold = """SELECT r, f.tree, f.lvl + 1 AS lvl, pos // 3 AS pos,
                     sha256(array_to_string(hs[:pos % 3] || [h] || hs[pos % 3 + 2:], '')) AS h,
                     proof || array_to_string(hs[:pos % 3] || hs[pos % 3 + 2:], '') AS proof
              FROM {0} f JOIN {1} k ON k.tree = f.tree AND k.lvl = f.lvl AND k.parent = pos // 3"""
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, sha256({head} || {_field_sql("text")}) AS leaf,
    CASE WHEN {_CRC32} % 2 = 0 THEN sha256({head} || {_field_sql("replace(text, chr(10), '')")}) END AS altered FROM documents),
l AS (SELECT *, coalesce('=' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM d),
t AS (SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM l UNION ALL {level.format("t")}),
k AS MATERIALIZED ({kids.format("t")}),
sub AS (SELECT tree AS name, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT '' AS tree, 0 AS lvl, pos, h, n FROM sub UNION ALL {level.format("u")}),
ku AS MATERIALIZED ({kids.format("u")}),
f AS (SELECT r, tree, 0 AS lvl, pos, coalesce(altered, leaf) AS h, '' AS proof FROM l UNION ALL {fold.format("f", "k")}),
f1 AS (SELECT r, f.h, proof, sub.pos, sub.h AS subroot FROM f JOIN (SELECT tree, max(lvl) AS lvl FROM t GROUP BY tree) m USING (tree, lvl)
       JOIN sub ON sub.name = f.tree),
g AS (SELECT r, '' AS tree, 0 AS lvl, pos, h, proof FROM f1 UNION ALL {fold.format("g", "ku")})
SELECT doc_id, leaf, subroot, root.h AS root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = root.h AS verified
FROM l JOIN f1 USING (r) JOIN g USING (r), (SELECT h, lvl FROM u WHERE n = 1) root WHERE g.lvl = root.lvl"""


@query("op12_midstate_tree", _merkle_sql())
def op12_midstate_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), candidate={"text": text})
    digests = [F.lower(F.hex(c)).alias(n) for c, n in (
        ("leaf", "leaf"), ("subroot", "subroot"), ("root", "root"), ("proof", "proof_sha256"),
        ("folded_root", "folded_root"))]
    return found.select(F.col("key").alias("doc_id"), *digests, (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_digest_cache")
def op13_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counts.token_counts(docs, tokenizer_file("word_bpe_49k.json"), limit=2048)
