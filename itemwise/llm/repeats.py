"""Shared Spark flow of the two repeat finders (byte and word level).

Every window of a fixed width is assigned to one *anchor* that its own
content determines, so equal windows meet under equal anchor keys at equal
offsets.  Neighbouring windows with the same anchor form a *chunk*; a text
yields one small row (key, fingerprint, place) for each chunk instead of one
for each window.  Then

1. ``candidates`` keeps the chunks whose key occurs twice or more: counts are
   combined map-side and written, so that both sides of the join are plain
   exchanges, of which adaptive execution splits the hot keys;
2. ``classes`` groups equal chunks (key, fingerprint), so copies cost one row;
3. only keys with several classes need a closer look, at one representative
   of each class, by the method of the operator;
4. ``with_spans`` brings the found ranges back to their texts.

Rows are told apart by (doc_id, 32-bit text hash): rows that repeat a doc_id
with another text are separate texts; wholly equal rows share one result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.session import release_shuffles, small_batches, write_scratch

ROW = ["doc_id", "th"]


def identified(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, th, text) of every row."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.hash(text).alias("th"), F.col(text).alias("text"))


def same(left: DataFrame, right: DataFrame, keys: list[str]):
    """Null-safe equality of the named columns."""
    cond = left[keys[0]].eqNullSafe(right[keys[0]])
    for k in keys[1:]:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def candidates(anchors: DataFrame, name: str) -> DataFrame:
    """Chunks (key, fp, doc_id, th, at, n) whose key occurs more than once."""
    keys = write_scratch(anchors.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
                         .where("c > 1").select("key"), f"{name}-keys")
    found = write_scratch(anchors.join(keys, "key"), name)
    release_shuffles(anchors.sparkSession)
    return found


def classes(found: DataFrame, name: str) -> DataFrame:
    """One row (key, fp, c, first, k) for each distinct chunk: its number of
    occurrences, its first place and the number of classes of its key."""
    each = found.groupBy("key", "fp").agg(
        F.count(F.lit(1)).alias("c"),
        F.min(F.struct("doc_id", "at", "th", "n")).alias("first"))
    each = write_scratch(each, name)
    several = write_scratch(each.groupBy("key").agg(F.count(F.lit(1)).alias("k")), f"{name}-keys")
    return each.join(several, "key")


def texts_with(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, th, text, items) of the texts named by ``places`` rows
    (doc_id, th, item); a text's items are bounded by its own length."""
    lists = places.groupBy(*ROW).agg(F.collect_list("item").alias("items"))
    joined = docs.join(lists, same(docs, lists, ROW))
    return joined.select(docs["doc_id"], docs["th"], "text", "items")


def with_spans(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``__spans``, the list of its ranges [s, e),
    null where it has none; all its columns are kept."""
    lists = spans.groupBy(*ROW).agg(F.collect_list(F.struct("s", "e")).alias("__spans"))
    lists = write_scratch(lists.withColumnsRenamed({"doc_id": "__id", "th": "__th"}), "spans")
    release_shuffles(docs.sparkSession)
    joined = docs.join(lists, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.hash(text) == F.col("__th")), "left")
    return joined.drop("__id", "__th")
