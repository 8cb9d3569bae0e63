"""Benchmark decontamination by spaced-seed hashing (operator 7), DataFrame
functions only.

A mask of wanted and ignored places slides over a document's words; the words
at its wanted places are hashed, so a changed word at an ignored place does
not hide a copy.  Seeds of documents and benchmark items are joined; a hit
fixes how the two texts lie to each other, and there all words of the item
are compared: an item leaks if at least ``TOLERANCE`` percent of ``EXTENT``
words (of the whole item if it is shorter) are equal.  The light masks of
``COVER`` join the fixed ones: wherever the words lie that ``TOLERANCE``
allows to differ within ``EXTENT`` words or a shorter item, one of them is
intact, so no such copy is without a hit.

The benchmark's seeds are broadcast after a check of their number; a larger
benchmark goes through a shuffle join that carries places instead of texts.

Input handling: words are lower-case runs of letters and digits; null texts
have none; items of fewer than ``LEAST_WORDS`` words are no evidence and
never leak, items shorter than a mask use the shorter ones; repeated rows
give repeated pairs once; a null id is kept as null; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemwise.llm import repeats as R
from itemwise.session import write_scratch

# Fixed masks: 1 = hashed, 0 = ignored.
MASKS = ["110100110101", "111010010011"]
# For an item of any number of words from LEAST_WORDS on, every choice of the
# words that may differ leaves one of these intact (the test enumerates them).
COVER = ["1111", "11101", "11011", "10111"]
LEAST_WORDS = 5
EXTENT = 20
TOLERANCE = 80
MAX_SEEDS = 1_000_000        # seeds (some 100 bytes each) that may be broadcast
SPLIT = r"[^\p{L}\p{N}]+"


def words_of(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPLIT), lambda w: w != "")


def _seeds(words: Column, place: Column, n: Column, masks: list[str]) -> Column:
    """Hashes of the masks that fit at ``place``; nulls where they do not."""
    out = []
    for k, mask in enumerate(masks):
        parts = [F.get(words, place + j) for j, bit in enumerate(mask) if bit == "1"]
        out.append(F.when(place + len(mask) <= n, F.xxhash64(F.lit(k), *parts)))
    return F.array(*out)


def _places(frame: DataFrame, masks: list[str]) -> DataFrame:
    """A row (place, h) for each seed of the frame's ``w``.  The outer form
    keeps Spark from pushing a second split of the text below the explode."""
    shortest = min(map(len, masks))
    last = F.size("w") - shortest
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    frame = frame.withColumn("place", F.explode_outer(places)).where("place IS NOT NULL")
    frame = frame.withColumn("h", F.explode(_seeds(F.col("w"), F.col("place"), F.size("w"), masks)))
    return frame.where("h IS NOT NULL")


def _beside(words: Column, shift: Column, n: Column) -> Column:
    """The words that lie beside an item of n words at this shift."""
    return F.slice(words, F.greatest(shift, F.lit(0)) + 1, n + F.least(shift, F.lit(0)))


def _matched(beside: Column, item: Column, shift: Column) -> Column:
    """Number of the item's words that equal the words beside them."""
    skip = F.greatest(-shift, F.lit(0))
    equal = F.transform(item, lambda x, j: F.when(
        (j >= skip) & (x == F.get(beside, j - skip)), 1).otherwise(0))
    return F.aggregate(equal, F.lit(0), lambda a, e: a + e)


def _needed(size: Column) -> Column:
    return F.ceil(F.least(size, F.lit(EXTENT)) * TOLERANCE / 100)


def leaks(docs: DataFrame, benchmark: DataFrame, masks: list[str] = MASKS, max_seeds: int = MAX_SEEDS) -> DataFrame:
    """(doc_id, th, item_id, item_words, matched) of every document and item
    that leaks into it; ``docs`` is ``repeats.identified(...)``."""
    items = (benchmark.select("item_id", words_of("text").alias("iw"))
             .where(F.size("iw") >= LEAST_WORDS).dropDuplicates(["item_id", "iw"])
             .withColumn("ik", F.xxhash64("item_id", "iw")))
    # One small pass over the benchmark: the number of its seeds.
    n_words = items.agg(F.coalesce(F.sum(F.size("iw")), F.lit(0)).alias("n")).first().n
    used = [*masks, *COVER]
    seeds = _places(items.withColumnRenamed("iw", "w"), used)
    seeds = seeds.select("ik", F.size("w").alias("n"), F.col("place").alias("ip"), "h")
    texts = docs.select("doc_id", "th", words_of("text").alias("w"))
    shift = F.col("place") - F.col("ip")
    where = ["doc_id", "th", "ik", "shift"]
    if n_words * len(used) <= max_seeds:
        hits = _places(texts, used).join(F.broadcast(seeds), "h")
        # One row for each way that two texts lie; only the words beside the item go on.
        hits = hits.select("doc_id", "th", "ik", shift.alias("shift"), _beside(F.col("w"), shift, F.col("n")).alias("b"))
        met = hits.groupBy(*where).agg(F.first("b").alias("b"))
    else:
        places = _places(texts, used).select("doc_id", "th", "place", "h")
        hits = places.join(seeds, "h").select("doc_id", "th", "ik", shift.alias("shift"), "n").distinct()
        hits = write_scratch(hits, "seed-hits")
        met = texts.join(hits, R.same(texts, hits, R.ROW)).select(
            texts["doc_id"], texts["th"], "ik", "shift", _beside(F.col("w"), F.col("shift"), F.col("n")).alias("b"))
    met = met.join(items, "ik").select("doc_id", "th", "item_id", F.size("iw").alias("item_words"),
                                       _matched(F.col("b"), F.col("iw"), F.col("shift")).alias("matched"))
    return (met.where(F.col("matched") >= _needed(F.col("item_words")))
            .groupBy("doc_id", "th", "item_id")
            .agg(F.max("item_words").cast("long").alias("item_words"), F.max("matched").cast("long").alias("matched")))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, item_words, matched): the leaks of ``docs``."""
    found = leaks(R.identified(docs), benchmark, **options)
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max("item_words").alias("item_words"), F.max("matched").alias("matched")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that an item leaks into."""
    named = docs.withColumn("__th", F.hash("text"))
    bad = leaks(R.identified(docs), benchmark, **options).select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__bad")).distinct()
    kept = named.join(bad, named["doc_id"].eqNullSafe(bad["__id"]) & (named["__th"] == bad["__bad"]), "left_anti")
    return kept.drop("__th")
