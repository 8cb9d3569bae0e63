"""Quality rules with adaptive thresholds (operator 2), DataFrame functions only.

Every text is measured in its own row.  Besides two fixed base rules, each
ratio is held against a threshold that its own language and source set: a
histogram sketch of the ratio (exact below 64, 32 buckets for each power of
two above, so quantiles are within 1/32) is kept for each (language, source).
Sketches are counts, so they merge by adding: Spark combines them map-side,
and those of small sources fall back on their language's merged sketch or on
all documents'.  A document is rejected when a ratio lies beyond

    upper quartile + 3 * (upper quartile - lower quartile) + slack

The thresholds come back by a join on (language, source), salted, since one
source may hold a large part of all rows.

Input handling: null text has no words and fails the base rules; null
language or source are a value like any other; repeated rows are judged
alike; an empty table gives no rows; columns that bear a result's name are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemwise.session import write_scratch

BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 20               # base rule
REPEAT_PERCENT = 30          # base rule
WINDOW = 8                   # words of a repeat window
LEAST_DOCUMENTS = 100        # below, a sketch is merged into a wider one
FENCE = 3                    # interquartile ranges beyond the quartile
SALTS = 16
# Ratio -> slack beyond the fence, in the ratio's unit (thousandths; word length: hundredths).
SLACK = {"symbol_ratio": 60, "capital_ratio": 350, "dup_line_ratio": 350, "word_length": 600}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
RESULT = [*BASE, *SLACK, "kept"]


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the text."""
    def windows() -> Column:
        return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW),
                                               lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW))))

    def covered(places: Column) -> Column:
        gaps = F.transform(F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0))),
                           lambda p, k: F.least(F.lit(WINDOW), p - F.get(places, k)))
        return WINDOW + F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda e, j: F.coalesce(e["h"] == F.get(pairs, j - 1)["h"], F.lit(False))
                         | F.coalesce(e["h"] == F.get(pairs, j + 1)["h"], F.lit(False)))
        return _let(F.array_sort(F.transform(twice, lambda e: e["i"])), covered)

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(pairs, repeated))

    return F.coalesce(_let(windows(), count), F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts and the ratios of every text."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in RESULT]
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__t"))
    rows = rows.withColumns({
        "__w": F.filter(F.split("__t", f"{BLANK}+"), lambda w: w != ""),
        "__l": F.filter(F.split("__t", "\n"), lambda x: x.rlike(f"[^{BLANK[1:]}")),
        "word_chars": (F.length("__t") - _count_of(F.col("__t"), BLANKS)).cast("long"),
        "n_symbols": _count_of(F.col("__t"), SYMBOLS).cast("long"),
        "__c": _count_of(F.col("__t"), CAPITALS).cast("long")})
    rows = rows.withColumns({
        "n_words": F.size("__w").cast("long"),
        "n_lines": F.size("__l").cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("__w"), F.size("__w")).cast("long")})
    rows = rows.withColumns({
        "symbol_ratio": F.expr("1000 * n_symbols div greatest(word_chars, 1)"),
        "capital_ratio": F.expr("1000 * __c div greatest(word_chars, 1)"),
        "dup_line_ratio": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
        "word_length": F.expr("100 * word_chars div greatest(n_words, 1)"),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))})
    return rows.drop("__t", "__w", "__l", "__c", "n_lines")


def bucket(value: Column) -> Column:
    """Sketch bucket of a whole number: itself below 64, then 32 buckets for
    each power of two."""
    bits = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(bits * 32 + F.call_function("shiftright", value, bits))


def bucket_top(b: Column) -> Column:
    """Largest value of a bucket."""
    bits = (F.call_function("shiftright", b, F.lit(5)) - 1).cast("int")
    return F.when(b < 64, b).otherwise(F.call_function("shiftleft", (b % 32) + 33, bits) - 1)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, metric, b, c): bucket counts of every ratio."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in SLACK])
    return (rows.select("lang", "source", F.explode(pairs).alias("p"))
            .groupBy("lang", "source", F.col("p.metric").alias("metric"), bucket(F.col("p.v")).alias("b"))
            .agg(F.count(F.lit(1)).alias("c")))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of wider groups: counts added up."""
    return sketch.groupBy(*keys, "metric", "b").agg(F.sum("c").alias("c"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, n, fence) from the quartiles of each sketch; a sketch
    has a bounded number of buckets."""
    group = Window.partitionBy(*keys, "metric")
    running = sketch.withColumns({
        "n": F.sum("c").over(group),
        "upto": F.sum("c").over(group.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    at = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("n"), F.col("b")))
    low, high = bucket_top(F.col("q1")), bucket_top(F.col("q3"))
    slack = F.create_map(*[F.lit(x) for m, s in SLACK.items() for x in (m, s)])
    return (running.groupBy(*keys, "metric", "n").agg(at(1).alias("q1"), at(3).alias("q3"))
            .select(*keys, "metric", "n", (high + FENCE * (high - low) + slack[F.col("metric")]).alias("fence")))


def thresholds(rows: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """One row (lang, source, a threshold for each ratio) for each source."""
    fine = sketches(rows)
    wide, whole = merged(fine, ["lang"]), merged(fine, [])
    own = fences(fine, ["lang", "source"])
    lang = fences(wide, ["lang"]).select(F.col("lang").alias("wl"), F.col("metric").alias("wm"),
                                         F.col("n").alias("wn"), F.col("fence").alias("wf"))
    total = fences(whole, []).select(F.col("metric").alias("tm"), F.col("fence").alias("tf"))
    chosen = (own.join(lang, F.col("lang").eqNullSafe(F.col("wl")) & (F.col("metric") == F.col("wm")))
              .join(total, F.col("metric") == F.col("tm"))
              .withColumn("fence", F.when(F.col("n") >= least, F.col("fence"))
                          .when(F.col("wn") >= least, F.col("wf")).otherwise(F.col("tf"))))
    pick = [F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"max_{m}") for m in SLACK]
    return chosen.groupBy("lang", "source").agg(*pick)


def judged(rows: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``rows`` (from ``measured``, best written once) with ``kept``."""
    limits = thresholds(rows, least).withColumnsRenamed({"lang": "__lang", "source": "__source"})
    limits = limits.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = salted.join(limits, salted["lang"].eqNullSafe(limits["__lang"])
                         & salted["source"].eqNullSafe(limits["__source"])
                         & (salted["__salt"] == limits["__salt"]))
    fine = ~F.col("base_failed")
    for m in SLACK:
        fine = fine & (F.col(m) <= F.col(f"max_{m}"))
    return joined.select(*[salted[c] for c in rows.columns], fine.alias("kept"))


def quality_rules(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` with measures and ``kept``; the measured rows are written once
    and read twice."""
    return judged(write_scratch(measured(docs), "measured"), least)
