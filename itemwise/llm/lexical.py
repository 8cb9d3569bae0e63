"""Ranked lexical search over a length-stratified index (operator 11).

Terms are the maximal runs of ASCII letters, digits and all characters beyond
ASCII, with A-Z lower-cased.  N documents hold a term, L terms in all; a
document of n terms has the normaliser m = 25 + 75*n*N div L, and documents of
equal m form a *stratum*.

``build_index`` writes one table.  A task packs its documents into shards of
some ``SHARD_POSTINGS`` postings, so nothing is shuffled and no frequent term
meets in one task.  A shard has a head row (null term, the doc_ids in
ascending order) and a row for each term, whose postings are grouped by
(m, tf): the places of the documents of a stratum that hold the term tf times.

``search`` takes the queries in blocks of bounded bytes.  For each shard and
query it bounds every stratum by the sum of its terms' largest impacts there,
visits the strata from the highest bound down, and stops when the next bound
is below the k-th score found.  An impact is computed once for each tf of a
stratum.  Only a shard's k best rows of a query leave its task; they are
ranked in two steps, so no task sees the rows of all shards.  Scores are exact
64-bit integers; equal scores rank by ascending doc_id.

Input handling: null and empty texts have no terms and are never found; rows
that repeat a doc_id are ranked one by one; a null doc_id sorts first; equal
query rows (id and text) count once, while equal ids with other texts are
ranked apart; a query without terms, or with none that occurs, gives no row;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemwise.llm import arrays as A
from itemwise.session import small_batches, write_scratch

# A term, in bytes of lower-cased text.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SHARD_POSTINGS = 1 << 20     # a shard ends at the document that reaches it
BLOCK_BYTES = 4 << 20        # bytes of query text that are searched at a time
SALTS = 64

INDEX = ("shard long, term binary, n_docs int, ids array<bigint>, "
         "postings array<struct<m: bigint, tf: int, docs: array<int>>>")
FOUND = "query int, shard long, place int, doc_id long, score long"


@dataclass
class Index:
    """The written table and the corpus figures that its strata rest on."""
    table: DataFrame
    n_docs: int
    n_terms: int


def terms_of(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())


_IN_TERM = np.zeros(256, bool)
_IN_TERM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_IN_TERM[0x80:] = True


def _size_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a term and all their terms, a row for each batch."""
    for batch in batches:
        data, at = A.texts_of(batch.column(0))
        docs = terms = 0
        for lo, hi in A.slices(at):
            inside = _IN_TERM[data[at[lo]:at[hi]]]
            offsets = at[lo:hi] - at[lo]
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            full = offsets[at[lo:hi] < at[lo + 1:hi + 1]]
            starts[full] = inside[full]          # a run never goes on from the text before
            where = np.flatnonzero(starts)
            terms += len(where)
            docs += len(np.unique(np.searchsorted(offsets, where, "right")))
        yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["docs", "terms"])


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """N and L."""
    sizes = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_size_batches, "docs long, terms long")
    row = sizes.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
    return row["docs"], row["terms"]


# --- the index -----------------------------------------------------------------

def _lists(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), values)


def _last_of_runs(*keys: np.ndarray) -> np.ndarray:
    """Exclusive ends of the runs of equal neighbouring keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(keys[0]) - 1, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change) + 1, len(keys[0]))


class _Shard:
    def __init__(self):
        self.ids, self.m, self.sizes = [], [], []
        self.terms, self.tf = [], []
        self.vocabulary: dict[bytes, int] = {}

    def add(self, doc_id: int | None, words: list[bytes], m: int) -> None:
        counts = Counter(words)
        known = self.vocabulary
        self.terms.extend([known.setdefault(t, len(known)) for t in counts])
        self.tf.extend(counts.values())
        self.ids.append(doc_id)
        self.m.append(m)
        self.sizes.append(len(counts))

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        """The head row, then a row for each term in byte order."""
        by_id = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is not None, self.ids[i] or 0))
        place = np.empty(len(by_id), np.int32)
        place[by_id] = np.arange(len(by_id), dtype=np.int32)
        words = sorted(self.vocabulary)
        order = np.empty(len(words), np.int64)
        order[[self.vocabulary[w] for w in words]] = np.arange(len(words))
        term = order[np.array(self.terms, np.int64)]
        m = np.repeat(np.array(self.m, np.int64), self.sizes)
        docs = np.repeat(place, self.sizes)
        tf = np.array(self.tf, np.int32)
        at = np.lexsort((docs, tf, m, term))
        term, m, tf, docs = term[at], m[at], tf[at], docs[at]
        ends = _last_of_runs(term, m, tf)
        groups = pa.StructArray.from_arrays(
            [pa.array(m[ends - 1]), pa.array(tf[ends - 1]), _lists(pa.array(docs), ends)], ["m", "tf", "docs"])
        owner = term[ends - 1]
        n_docs = np.bincount(term, minlength=len(words)).astype(np.int32)
        group_ends = _last_of_runs(owner)
        ids = pa.array([[self.ids[i] for i in by_id]], pa.list_(pa.int64()))
        names = ["shard", "term", "n_docs", "ids", "postings"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.nulls(1, pa.binary()), pa.array([len(by_id)], pa.int32()), ids,
             pa.nulls(1, pa.list_(groups.type))], names)
        every = pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(words), number)), pa.array(words, pa.binary()), pa.array(n_docs),
             pa.nulls(len(words), ids.type), _lists(groups, group_ends)], names)
        for s in range(0, len(words), 8192):
            yield every.slice(s, 8192)


def _pack(n_docs: int, n_terms: int, shard_postings: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = terms_of(text.as_py() or b"")
                if not words:
                    continue
                shard.add(doc_id, words, 25 + 75 * len(words) * n_docs // n_terms)
                if len(shard.terms) >= shard_postings:
                    yield from shard.batches(number)
                    number, shard = number + 1, _Shard()
        if shard.ids:
            yield from shard.batches(number)
    return pack


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text",
                shard_postings: int = SHARD_POSTINGS) -> Index:
    """Index of every row of ``docs``, written below the shared folder."""
    small_batches(docs.sparkSession)
    n_docs, n_terms = corpus_size(docs, text)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    table = rows.mapInArrow(_pack(n_docs, n_terms, shard_postings), INDEX)
    return Index(write_scratch(table, "lexical-index"), n_docs, n_terms)


# --- the search ----------------------------------------------------------------

class _Query:
    """Term rows of a query and their weights times the repeats."""

    def __init__(self, counts: dict[int, int], weights: np.ndarray):
        used = [(t, c * int(weights[t])) for t, c in counts.items() if weights[t] > 0]
        self.terms = [t for t, _ in used]
        self.weights = [w for _, w in used]


class _Strata:
    """Postings of one shard for the terms of a block."""

    def __init__(self, table: pa.Table, number_of: dict[bytes, int]):
        rows = table.combine_chunks()
        terms = rows["term"].to_pylist()
        head = terms.index(None)
        self.ids = rows["ids"][head].as_py()
        lists = rows["postings"].chunk(0)
        keep = pa.array([i for i, t in enumerate(terms) if t is not None], pa.int64())
        lists = lists.take(keep)
        groups = lists.flatten()
        m, tf = groups.field("m").to_numpy(), groups.field("tf").to_numpy().astype(np.int64)
        places = groups.field("docs")
        self.docs = places.flatten().to_numpy()
        self.sizes = places.value_lengths().to_numpy().astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.m, stratum = np.unique(m, return_inverse=True)
        # One impact for each tf of a stratum.
        wide = int(tf.max(initial=0)) + 1
        pairs, which = np.unique(stratum * wide + tf, return_inverse=True)
        pair_tf = pairs % wide
        self.impact = (10**9 * pair_tf // (1000 * pair_tf + 8 * self.m[pairs // wide]))[which]
        # Runs of a term's groups in one stratum; the last has the largest tf.
        bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        owner = np.repeat(np.arange(len(keep)), np.diff(bounds))
        run_ends = _last_of_runs(owner, stratum)
        run_starts = np.concatenate(([0], run_ends)).astype(np.int64)[:-1]
        top = self.impact[run_ends - 1]
        cuts = np.searchsorted(owner[run_starts], np.arange(len(keep) + 1))
        self.runs = {}
        for k, i in enumerate(keep.to_pylist()):
            s = slice(cuts[k], cuts[k + 1])
            self.runs[number_of[terms[i]]] = (stratum[run_starts[s]], run_starts[s], run_ends[s], top[s])

    def _postings(self, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and weighted impacts of the groups [start, end) of each run."""
        group = _ranges(starts, ends)
        weighted = self.impact[group] * np.repeat(weights, ends - starts)
        return self.docs[_ranges(self.starts[group], self.ends[group])], np.repeat(weighted, self.sizes[group])

    def best(self, query: _Query, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents."""
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        mine = [(*self.runs[t], w) for t, w in zip(query.terms, query.weights) if t in self.runs]
        if not mine:
            return places, scores
        stratum, starts, ends, top = (np.concatenate(x) for x in zip(*(m[:4] for m in mine)))
        weights = np.repeat([m[4] for m in mine], [len(m[0]) for m in mine])
        bound = np.zeros(len(self.m), np.int64)
        np.add.at(bound, stratum, weights * top)
        order = np.argsort(-bound, kind="stable")
        order = order[:np.count_nonzero(bound)]
        rank = np.empty(len(bound), np.int64)
        rank[order] = np.arange(len(order))
        by_visit = np.argsort(rank[stratum], kind="stable")
        starts, ends, weights = starts[by_visit], ends[by_visit], weights[by_visit]
        first = np.searchsorted(rank[stratum][by_visit], np.arange(len(order) + 1))     # runs of a visit
        score = np.zeros(len(self.ids), np.int64)
        done, step = 0, 4
        while done < len(order):
            if len(scores) == k and bound[order[done]] < scores[-1]:
                break
            upto = min(done + step, len(order))
            at = slice(first[done], first[upto])
            docs, points = self._postings(starts[at], ends[at], weights[at])
            np.add.at(score, docs, points)
            hit = np.flatnonzero(score)
            places, scores = np.concatenate((places, hit)), np.concatenate((scores, score[hit]))
            best = np.lexsort((places, -scores))[:k]
            places, scores = places[best], scores[best]
            score[hit] = 0
            done, step = upto, 2 * step
        return places, scores


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, end), in order."""
    sizes = ends - starts
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _search_shard(words: list[bytes], queries: list[_Query], k: int):
    number_of = {t: i for i, t in enumerate(words)}

    def run(table: pa.Table) -> pa.Table:
        strata = _Strata(table, number_of)
        shard = table["shard"][0].as_py()
        out = {name: [] for name in ("query", "shard", "place", "doc_id", "score")}
        for q, query in enumerate(queries):
            places, scores = strata.best(query, k)
            out["query"] += [q] * len(places)
            out["shard"] += [shard] * len(places)
            out["place"] += places.tolist()
            out["doc_id"] += [strata.ids[p] for p in places.tolist()]
            out["score"] += scores.tolist()
        types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})
    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """Distinct (id, text bytes) rows, some ``block_bytes`` at a time."""
    block, size = [], 0
    for row in items.distinct().orderBy("id", "text").toLocalIterator():
        block.append((row["id"], bytes(row["text"] or b"")))
        size += len(block[-1][1])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    """``rank`` of the k best rows of each query; first within salted parts."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("shard"), F.asc("place")]
    parts = Window.partitionBy("query", F.pmod(F.hash("shard"), F.lit(SALTS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= k)
    whole = Window.partitionBy("query").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def _search_block(index: Index, block: list[tuple], id_type, k: int) -> DataFrame:
    spark = index.table.sparkSession
    counts = [Counter(terms_of(text)) for _, text in block]
    words = sorted(set().union(*counts))
    number_of = {t: i for i, t in enumerate(words)}
    # Bounded by the bytes of a block, as are the queries in the tasks' closure.
    wanted = F.broadcast(spark.createDataFrame(pa.table({"term": pa.array(words, pa.binary())})))
    hits = index.table.join(wanted, "term", "left_semi")
    df = np.zeros(len(words), np.int64)
    for row in hits.groupBy("term").agg(F.sum("n_docs").alias("df")).collect():
        df[number_of[bytes(row["term"])]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * d + 1))) if d else 0
                        for d in df.tolist()], np.int64)
    queries = [_Query({number_of[t]: c for t, c in each.items()}, weights) for each in counts]
    rows = index.table.where("term IS NULL").unionByName(hits)
    found = rows.groupBy("shard").applyInArrow(_search_shard(words, queries, k), FOUND)
    names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)],
                                  T.StructType([T.StructField("query", T.IntegerType()),
                                                T.StructField("item_id", id_type)]))
    best = _best_rows(found, k).join(F.broadcast(names), "query")
    return best.select("item_id", "rank", "doc_id", "score")


def search(index: Index, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 10,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each query with
    a score above 0, all of them if fewer."""
    rows = items.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType
    out = None
    for block in _blocks(rows, block_bytes):
        found = _search_block(index, block, id_type, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = items.sparkSession.createDataFrame(
            [], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")
    return out
