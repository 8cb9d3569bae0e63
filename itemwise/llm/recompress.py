"""Substring dedup by recompression (operator 9).

Round by round, every run of one symbol and then every (left, right) pair of
neighbours gets a new name.  A name is a 64-bit hash of what it stands for
and the left/right split of the symbols is a bit of their hash, so all tasks
name alike and the naming itself needs no shuffle.  For every symbol the
range of words that decided its name and borders is kept.  A symbol whose
range lies inside a window is the same, at the same offset, wherever that
window occurs: equal substrings share their interior symbols.

A window is filed under the least (by hash) of the highest-level symbols that
it determines, together with the words that decided it; windows without one
use the next lower level, words at last.  Spark counts these symbols of all
texts, and windows under shared symbols are
verified: chunks by fingerprint, the rest window by window.

Input handling: null or wordless texts have no words and lose nothing; texts
shorter than a window lose nothing; rows that repeat a doc_id count as the
same place in the order, so neither is "earlier" than the other; a null
doc_id sorts before all others; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm import arrays as A
from itemwise.llm import repeats as R
from itemwise.session import release_shuffles

_U = np.uint64
_MASK = (1 << 64) - 1
ANCHOR_SCHEMA = "key long, fp long, doc_id long, th int, at long, n int"


def grammar(words: np.ndarray, offsets: np.ndarray, rounds: int) -> list[tuple]:
    """Levels 0..rounds of symbols: (name, first word decided on, end of it).

    ``offsets`` are the word offsets of the texts; symbols stay in their text.
    """
    n = len(words)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    begin, finish = offsets[:-1][doc] - 1, offsets[1:][doc] + 1
    name, lo, hi = words, np.arange(n), np.arange(1, n + 1)
    levels = [(name, lo, hi)]
    for r in range(rounds):
        salt = _U(0x5851F42D4C957F2D * (2 * r + 1) & _MASK)
        # Runs: borders depend on the neighbours being different.
        joint = (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])
        first = np.flatnonzero(np.concatenate(([True], ~joint))) if n else np.zeros(0, np.int64)
        last = np.append(first[1:], len(name)) - 1 if n else first
        length = (last - first + 1).astype(_U)
        run = name[first]
        run = np.where(length > 1, A.mix(run + length * salt), run)
        d = doc[first]
        opens = np.concatenate(([True], d[1:] != d[:-1])) if n else np.zeros(0, bool)
        closes = np.concatenate((d[1:] != d[:-1], [True])) if n else opens
        lo = np.where(opens, begin[first], lo[np.maximum(first - 1, 0)])
        hi = np.where(closes, finish[first], hi[np.minimum(last + 1, max(len(name) - 1, 0))])
        begin, finish, name, doc = begin[first], finish[first], run, d
        # Pairs: a left symbol joins the right symbol that follows it.
        left = (A.mix(name + salt) & _U(1)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & ~left[1:] & ~closes[:-1]
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        at = np.flatnonzero(~second)
        is_pair, is_left = pair[at], left[at]
        end = at + is_pair
        joined = A.mix(name[at] * _U(0x2545F4914F6CDD1D) + A.mix(name[end]) + salt)
        new = np.where(is_pair, joined, name[at])
        lone_left, lone_right = ~is_pair & is_left, ~is_pair & ~is_left
        before = np.where(opens[at], begin[at], lo[np.maximum(at - 1, 0)])
        behind = np.where(closes[at], finish[at], hi[np.minimum(at + 1, max(len(name) - 1, 0))])
        lo, hi = (np.where(lone_right, before, lo[at]), np.where(lone_left, behind, hi[end]))
        begin, finish, name, doc = begin[at], finish[at], new, doc[at]
        levels.append((name, lo, hi))
    return levels


def chunks(words: np.ndarray, offsets: np.ndarray, width: int, rounds: int):
    """Chunks of windows under one symbol: (key, fingerprint, text number,
    first window's word in the text, number of windows)."""
    n = len(words)
    sizes = np.maximum(np.diff(offsets) - width + 1, 0)
    windows = A.concat_ranges(offsets[:-1], sizes)
    m = len(windows)
    if not m:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none.astype(_U), none, none, none
    bits = _U(max(28, n.bit_length()))   # fixed for all but giant slices, so ties fall alike
    chosen = np.full(m, -1, np.int64)
    key = np.zeros(m, _U)
    todo = np.arange(m)
    sums = A.prefix_sums(words)
    for level, (name, lo, hi) in reversed(list(enumerate(grammar(words, offsets, rounds)))):
        p = windows[todo]
        below = np.zeros(n + 3, np.int64)
        np.cumsum(np.bincount(lo + 1, minlength=n + 2)[:n + 2], out=below[1:])
        upto = np.cumsum(np.bincount(hi, minlength=n + 2))
        first, end = below[p + 1], upto[p + width]
        has = end > first
        order = ((A.mix(name) >> bits) << bits) | np.arange(len(name)).astype(_U)
        best = A.range_min(order, first[has], end[has]) & ((_U(1) << bits) - _U(1))
        best = best.astype(np.int64)
        use = todo[has]
        chosen[use] = best * (rounds + 1) + level
        key[use] = A.span_hashes(sums, lo[best], hi[best]) ^ _U(level)
        todo = todo[~has]
        if not len(todo):
            break
    text = np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(m, bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, m))
    start = windows[at]
    fp = A.span_hashes(sums, start, start + count + width - 1)
    return key[at], fp, text[at], start - offsets[:-1][text[at]], count


def _anchor_batches(width: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = A.texts_of(batch.column(2))
            ids, th = batch.column(0).cast(pa.int64()), batch.column(1)
            for lo, hi in A.slices(at):
                part, off = data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
                s, e, words = A.word_spans(part, off)
                key, fp, row, first, n = chunks(A.word_hashes(part, s, e), words, width, rounds)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), ids.take(take),
                     th.take(take), pa.array(first), pa.array(n.astype(np.int32))],
                    ["key", "fp", "doc_id", "th", "at", "n"])
    return run


def _window_batches(width: int):
    """Hash of every window of the listed chunks of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = A.texts_of(batch.column(2))
            ids, th = batch.column(0).cast(pa.int64()), batch.column(1)
            lists = batch.column(3)
            list_at = np.asarray(lists.offsets)
            fields = [np.asarray(f) for f in lists.values.flatten()]
            for lo, hi in A.slices(at):
                part, off = data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
                s, e, words = A.word_spans(part, off)
                sums = A.prefix_sums(A.word_hashes(part, s, e, 1), 1)
                a, b = list_at[lo], list_at[hi]
                key, first, n = (f[a:b] for f in fields)
                row = np.repeat(np.arange(hi - lo), np.diff(list_at[lo:hi + 1]))
                pos = A.concat_ranges(first + words[row], n.astype(np.int64))
                w = A.span_hashes(sums, pos, pos + width, 1)
                row, key = np.repeat(row, n), np.repeat(key, n)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(w.view(np.int64)), ids.take(take), th.take(take),
                     pa.array(pos - words[row])], ["key", "w", "doc_id", "th", "s"])
    return run


def later_spans(docs: DataFrame, width: int = 20, rounds: int = 2) -> DataFrame:
    """Word ranges (doc_id, th, s, e) covered by windows of ``width`` words
    whose word sequence also starts earlier (smaller doc_id, or the same
    document and an earlier start).  ``docs`` is ``repeats.identified(...)``."""
    spark = docs.sparkSession
    anchors = docs.mapInArrow(_anchor_batches(width, rounds), ANCHOR_SCHEMA)
    found = R.candidates(anchors, "word-chunks")
    each = R.classes(found, "word-classes")
    member = found.join(each.select("key", "fp", "first"), ["key", "fp"])
    place = F.struct("doc_id", "at")
    is_first = place.eqNullSafe(F.struct(F.col("first.doc_id").alias("doc_id"), F.col("first.at").alias("at")))
    whole = member.where(~is_first).select(
        "doc_id", "th", F.col("at").alias("s"), (F.col("at") + F.col("n") + (width - 1)).alias("e"))

    # Firsts of keys with several classes: window by window.
    firsts = each.where("k > 1").select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th"),
        F.struct("key", F.col("first.at").alias("at"), F.col("first.n").alias("n")).alias("item"))
    windows = R.texts_with(docs, firsts).mapInArrow(
        _window_batches(width), "key long, w long, doc_id long, th int, s long")
    windows = R.write_scratch(windows, "word-windows")
    release_shuffles(spark)
    earliest = (windows.groupBy("key", "w")
                .agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "s")).alias("first"))
                .where("c > 1"))
    single = (windows.join(earliest, ["key", "w"])
              .where(~F.struct("doc_id", "s").eqNullSafe(F.col("first")))
              .select("doc_id", "th", "s", (F.col("s") + width).alias("e")))
    return whole.unionByName(single)


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        texts, spans = batch.column(1), batch.column(2)
        for i in range(batch.num_rows):
            words = (texts[i].as_py() or "").encode().split()
            total = len(words)
            if spans[i].is_valid:
                pairs = spans[i].values.flatten()
                gone = A.covered(total, np.asarray(pairs[0]), np.asarray(pairs[1]))
                words = [words[j] for j in np.flatnonzero(~gone)]
            n_words.append(total)
            n_removed.append(total - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def substring_dedup(docs: DataFrame, width: int = 20, rounds: int = 2) -> DataFrame:
    """Every document without its later repeated words: doc_id, n_words,
    n_removed and kept (the remaining words joined by one space)."""
    marked = R.with_spans(docs.select("doc_id", "text"), later_spans(R.identified(docs), width, rounds))
    kind = dict(docs.dtypes)["doc_id"]
    return marked.mapInArrow(_kept_batches, f"doc_id {kind}, n_words long, n_removed long, kept string")
