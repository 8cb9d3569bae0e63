"""Suffix-array dedup with a common-prefix interval tree (operator 4).

Byte windows are filed under content-chosen anchors (``repeats``); only
chunks whose anchor occurs with different surroundings go on.  Their distinct
texts are sorted into enhanced suffix arrays (order and common-prefix
lengths, by prefix doubling), many anchors to an array of bounded size.  A
stack scan walks the interval tree of common prefixes; an interval whose
suffixes differ in the byte to their left is a maximal repeat, reported with
all its occurrences.  Chunks that are equal as a whole form one class and
enter once.  An anchor with more distinct chunks than ``crowd`` gets sparse
arrays instead (one suffix and one reversed prefix a chunk, the same scan),
and one with more than ``huge`` has its windows counted in Spark, combined
map-side, so no task ever holds an unbounded group.

Input handling: null text is empty; texts shorter than the width lose
nothing; matches never cross documents; equal rows (copies, or rows that
repeat a doc_id) are repeats of each other; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm import arrays as A
from itemwise.llm import repeats as R
from itemwise.session import release_shuffles, write_scratch

_U = np.uint64
GRAM = 48            # bytes of an anchor
CROWD = 512          # distinct chunks of one anchor that still share a full suffix array
HUGE = 50_000        # distinct chunks of one anchor that a task may hold (some 30 MB)
ORDER_BITS = 28      # low bits of an anchor's rank that hold its place; equal ranks: leftmost
BUFFER = 1 << 20     # bytes of chunk text in one suffix array
ANCHOR_SCHEMA = "key long, fp long, doc_id long, th int, at long, n int"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i+width]) for every i, by block prefix and suffix minima."""
    n = len(values)
    blocks = -(-n // width)
    grid = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    grid[:n] = values
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def chunks(data: np.ndarray, offsets: np.ndarray, width: int, gram: int):
    """Chunks of byte windows: (key, fingerprint, text number, first byte, windows)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    sizes = np.maximum(np.diff(offsets) - width + 1, 0)
    if n < width or not sizes.any():
        return none.astype(_U), none.astype(_U), none, none, none
    sums = A.byte_sums(data)
    inverse = A.powers(n + 1)[1]
    grams = A.mix((sums[gram:] - sums[:-gram]) * inverse[:n - gram + 1])
    bits = _U(max(ORDER_BITS, n.bit_length()))
    low = (_U(1) << bits) - _U(1)
    order = (grams & ~low) | np.arange(len(grams), dtype=_U)
    least = sliding_min(order, width - gram + 1)
    windows = A.concat_ranges(offsets[:-1], sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    chosen = (least[windows] & low).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(windows)))
    start = windows[at]
    fp = A.span_hashes(A.byte_sums(data, 1), start, start + count + width - 1, 1)
    return grams[chosen[at]], fp, text[at], start - offsets[:-1][text[at]], count


def _anchor_batches(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = A.texts_of(batch.column(2))
            ids, th = batch.column(0).cast(pa.int64()), batch.column(1)
            for lo, hi in A.slices(at):
                key, fp, row, first, n = chunks(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], width, gram)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), ids.take(take),
                     th.take(take), pa.array(first), pa.array(n.astype(np.int32))],
                    ["key", "fp", "doc_id", "th", "at", "n"])
    return run


def _chunk_texts(width: int):
    """(key, fp, k, n, chunk) of the listed chunks of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = A.texts_of(batch.column(2))
            lists = batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            key, fp, k, first, n = lists.flatten().flatten()
            start = at[row] + np.asarray(first)
            end = start + np.asarray(n) + width - 1
            raw = data.tobytes() if len(start) else b""
            texts = [raw[s:e] for s, e in zip(start.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays(
                [key, fp, k, n, pa.array(texts, pa.binary())], ["key", "fp", "k", "n", "chunk"])
    return run


def suffix_ranks(data: np.ndarray, ends: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all suffixes by their first 7, 14, ... bytes, at least
    ``depth``; ``ends[i]`` is the end of the text that position i lies in."""
    n = len(data)
    left = ends - np.arange(n)
    code = np.zeros(n, np.int64)
    padded = np.concatenate((data.astype(np.int64) + 1, np.zeros(7, np.int64)))
    for j in range(7):
        code = code * 257 + np.where(left > j, padded[j:j + n], 0)
    levels, h = [], 7
    while True:
        order = np.argsort(code, kind="stable") if h == 7 else np.argsort(code)
        ordered = code[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([1], 1 + np.cumsum(ordered[1:] != ordered[:-1])))
        levels.append((h, rank))
        if h >= depth or rank.max() == n:
            return levels
        code = rank * (n + 1)
        code[:-h] += np.where(left[:-h] > h, rank[h:], 0)
        h *= 2


def common_prefix(levels, data: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b."""
    n = len(ends)
    length = np.zeros(len(a), np.int64)
    most = np.minimum(ends[a] - a, ends[b] - b)

    def advance(values, h):
        x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
        go = (length < most) & (values[x] == values[y])
        return np.where(go, np.minimum(length + h, most), length)

    for h, rank in reversed(levels):
        # Equal ranks: equal for h bytes, or equal to the end of both texts.
        length = advance(rank, h)
    still = np.ones(len(a), bool)
    for _ in range(levels[0][0] - 1):
        longer = advance(data, 1)
        still &= longer > length
        length = np.where(still, longer, length)
    return length


def maximal_intervals(lcp: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of an enhanced suffix array: (length, first, last) of every
    common-prefix interval of at least ``least`` whose suffixes differ in the
    byte to their left.  ``lcp[i]`` joins entries i and i + 1."""
    mixed = None
    stack: list[list] = []   # [length, first entry, common left byte or None]
    for i in range(len(lcp) + 1):
        here = lcp[i] if i < len(lcp) else -1
        start, side = i, left[i]
        while stack and stack[-1][0] > here:
            length, start, own = stack.pop()
            own = own if own == side else mixed
            if own is mixed and length >= least:
                yield length, start, i
            side = own
        if here < 0:
            break
        if stack and stack[-1][0] == here:
            if stack[-1][2] != side:
                stack[-1][2] = mixed
        elif here >= 0:
            stack.append([here, start, side])


def repeat_groups(texts: list[bytes], counts: np.ndarray, least: int):
    """Maximal repeats of at least ``least`` bytes among chunks: arrays
    (group, length, chunk number, start in the chunk), all occurrences of
    each group.  Suffixes start at the first ``counts`` bytes of a chunk;
    nothing is known to the left of a chunk, so its first suffix is maximal."""
    none = np.zeros(0, np.int64)
    if len(texts) < 2:
        return none, none, none, none
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum(size)
    begin = end - size
    ends = np.repeat(end, size)
    chunk = np.repeat(np.arange(len(texts)), size)
    levels = suffix_ranks(data, ends, int(size.max()))
    starts = A.concat_ranges(begin, counts)
    sa = starts[np.argsort(levels[-1][1][starts], kind="stable")]
    lcp = common_prefix(levels, data, ends, sa[:-1], sa[1:])
    left = np.where(sa == begin[chunk[sa]], -1 - chunk[sa], data[np.maximum(sa - 1, 0)].astype(np.int64))
    # Top intervals: runs of lcp >= least; those of one left byte hold no maximal repeat.
    linked = np.concatenate(([False], lcp >= least, [False]))
    first = np.flatnonzero(~linked[:-1] & linked[1:])
    last = np.flatnonzero(linked[:-1] & ~linked[1:])
    found: list[tuple[int, int, int]] = []
    if len(first):
        bounds = np.stack((first, last + 1), 1).ravel()
        padded = np.append(left, left[-1:])
        low = np.minimum.reduceat(padded, bounds)[::2]
        high = np.maximum.reduceat(padded, bounds)[::2]
        for a, b in zip(first[low != high].tolist(), last[low != high].tolist()):
            for length, x, y in maximal_intervals(lcp[a:b].tolist(), left[a:b + 1].tolist(), least):
                found.append((length, a + x, a + y))
    if not found:
        return none, none, none, none
    length, x, y = np.array(found).T
    count = y - x + 1
    group = np.repeat(np.arange(len(found)), count)
    where = sa[A.concat_ranges(x, count)]
    return group, np.repeat(length, count), chunk[where], where - begin[chunk[where]]


def _repeat_batches(width: int, buffer: int):
    """Maximal repeats of sorted (key, fp, n, chunk) rows: rows (key, fp, s, e,
    grp) with grp naming the group inside its key.  A suffix array takes whole
    keys, at most ``buffer`` bytes and one key more."""
    def solve(key, fp, n, texts):
        group, length, which, start = repeat_groups(texts, np.array(n, np.int64), width)
        key, fp = np.array(key, np.int64)[which], np.array(fp, np.int64)[which]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (key, fp, start, start + length, group)], ["key", "fp", "s", "e", "grp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= buffer and row[0] != held[0][-1]:
                    yield solve(*held)
                    held, size = [[], [], [], []], 0
                for column, value in zip(held, row):
                    column.append(value)
                size += len(row[3])
        if held[0]:
            yield solve(*held)
    return run


def _neighbour_prefix(texts: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Sorted order of the texts and common prefix lengths of neighbours."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    out = np.zeros(max(len(texts) - 1, 0), np.int64)
    longest = max(map(len, texts), default=0) + 1
    for lo in range(0, len(out), 4096):
        part = [texts[i] for i in order[lo:lo + 4097]]
        size = np.array([len(t) for t in part])
        grid = np.zeros((len(part), longest), np.int16)
        grid[np.arange(longest) < size[:, None]] = np.frombuffer(b"".join(part), np.uint8).astype(np.int16) + 1
        differ = grid[:-1] != grid[1:]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), size[:-1])
        out[lo:lo + len(part) - 1] = np.minimum(same, np.minimum(size[:-1], size[1:]))
    return order, out


def anchored_reach(texts: list[bytes], at: list[int], least: int) -> tuple[list[int], list[int]]:
    """How far to the left and right of its anchor ``at`` each chunk is
    covered by repeats of at least ``least`` bytes that hold the anchor (-1:
    not at all).  Interval tree of the suffixes from the anchors; members of
    an interval are kept in the order of their reversed prefixes, where the
    nearest members agree furthest."""
    m = len(texts)
    order, right = _neighbour_prefix([t[a:] for t, a in zip(texts, at)])
    left_order, left = _neighbour_prefix([t[:a][::-1] for t, a in zip(texts, at)])
    rank = [0] * m
    for i, x in enumerate(left_order):
        rank[x] = i
    table = [left]
    while len(table[-1]) > 1 << (len(table) - 1):
        t, half = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(t[:-half], t[half:]))
    table = [t.tolist() for t in table]
    by_rank = left_order
    reach_l, reach_r = [-1] * m, [-1] * m

    def meet(x: int, y: int, r: int) -> None:
        """Members of ranks x < y agree for r bytes to the right."""
        k = (y - x).bit_length() - 1
        both = min(table[k][x], table[k][y - (1 << k)])
        if both + r >= least:
            for i in (by_rank[x], by_rank[y]):
                reach_l[i] = max(reach_l[i], both)
                reach_r[i] = max(reach_r[i], r)

    def merge(big: list[int], small: list[int], r: int) -> list[int]:
        if len(big) < len(small):
            big, small = small, big
        for x in small:
            i = bisect_left(big, x)
            if i:
                meet(big[i - 1], x, r)
            if i < len(big):
                meet(x, big[i], r)
            big.insert(i, x)
        return big

    stack: list[tuple[int, list[int]]] = []       # (common prefix with what follows, members)
    for i in range(m):
        members = [rank[order[i]]]
        here = int(right[i]) if i < m - 1 else -1
        while stack and stack[-1][0] >= here:
            r, before = stack.pop()
            members = merge(before, members, r)
        stack.append((here, members))
    return reach_l, reach_r


def _reach_batches(width: int, gram: int):
    """Covered range (key, fp, s, e) of the chunks of crowded anchors, from
    rows (key, fp, n, chunk) sorted by key."""
    def solve(key, fps, texts):
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.cumsum([0] + [len(t) for t in texts[:-1]])
        sums, inverse = A.byte_sums(data), A.powers(len(data) + 1)[1]
        at = []
        for b in begin.tolist():                   # the first window's anchor is the chunk's
            grams = A.mix((sums[b + gram:b + width + 1] - sums[b:b + width - gram + 1])
                          * inverse[b:b + width - gram + 1])
            at.append(int(np.argmin(grams >> _U(ORDER_BITS))))
        l, r = anchored_reach(texts, at, width)
        rows = [(fp, a - x, a + y) for fp, a, x, y in zip(fps, at, l, r) if x >= 0]
        columns = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array([key] * len(rows), pa.int64()), *(pa.array(c, pa.int64()) for c in columns),
             pa.nulls(len(rows), pa.int64())], ["key", "fp", "s", "e", "grp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fps, texts = None, [], []
        for batch in batches:
            for key, fp, chunk in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if texts and key != now:
                    yield solve(now, fps, texts)
                    fps, texts = [], []
                now = key
                fps.append(fp)
                texts.append(chunk)
        if texts:
            yield solve(now, fps, texts)
    return run


def _window_batches(width: int):
    """(key, fp, w, s): hash of every window of the given chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp, n = (np.asarray(batch.column(i)) for i in range(3))
            texts = batch.column(3).to_pylist()
            for lo in range(0, len(texts), 1024):
                part = texts[lo:lo + 1024]
                count = n[lo:lo + 1024].astype(np.int64)
                end = np.cumsum([len(t) for t in part])
                begin = end - np.array([len(t) for t in part])
                pos = A.concat_ranges(begin, count)
                w = A.span_hashes(A.byte_sums(np.frombuffer(b"".join(part), np.uint8), 1), pos, pos + width, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(key[lo:lo + 1024], count)), pa.array(np.repeat(fp[lo:lo + 1024], count)),
                     pa.array(w.view(np.int64)), pa.array(pos - np.repeat(begin, count))],
                    ["key", "fp", "w", "s"])
    return run


def repeated_chunks(docs: DataFrame, width: int = 400, gram: int = GRAM, crowd: int = CROWD,
                    huge: int = HUGE, buffer: int = BUFFER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(found, each, spans): all chunks that may repeat, their classes, and
    the ranges (key, fp, s, e, grp) of a class's chunk covered by maximal
    repeats.  ``docs`` is ``repeats.identified(...)``."""
    anchors = docs.mapInArrow(_anchor_batches(width, gram), ANCHOR_SCHEMA)
    found = R.candidates(anchors, "byte-chunks")
    each = R.classes(found, "byte-classes")
    item = F.struct("key", "fp", "k", F.col("first.at").alias("at"), F.col("first.n").alias("n"))
    firsts = each.where("k > 1").select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th"), item.alias("item"))
    # Copies share their first place, so a chunk may be read from several equal rows: once is enough.
    texts = R.texts_with(docs, firsts).mapInArrow(
        _chunk_texts(width), "key long, fp long, k long, n int, chunk binary")
    texts = write_scratch(texts, "byte-chunk-texts")
    release_shuffles(docs.sparkSession)
    row, spans_of = ["key", "fp", "n", "chunk"], "key long, fp long, s long, e long, grp long"

    def by_key(part: DataFrame) -> DataFrame:
        return part.select(*row).repartition("key").sortWithinPartitions("key", "fp")

    k = F.col("k")
    spans = by_key(texts.where(k <= crowd)).mapInArrow(_repeat_batches(width, buffer), spans_of)
    crowded = by_key(texts.where((k > crowd) & (k <= huge))).mapInArrow(_reach_batches(width, gram), spans_of)
    windows = (texts.where((k > crowd) & (k > huge)).select(*row)
               .mapInArrow(_window_batches(width), "key long, fp long, w long, s long"))
    twice = windows.groupBy("key", "w").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    rest = (windows.join(twice, ["key", "w"])
            .select("key", "fp", "s", (F.col("s") + width).alias("e"), F.lit(None).cast("long").alias("grp")))
    return found, each, spans.unionByName(crowded).unionByName(rest)


def repeated_spans(docs: DataFrame, width: int = 400, **options) -> DataFrame:
    """Byte ranges (doc_id, th, s, e) covered by strings of ``width`` bytes
    that start anywhere else too."""
    found, each, spans = repeated_chunks(docs, width, **options)
    copies = found.join(each.where("c > 1").select("key", "fp"), ["key", "fp"])
    whole = copies.select("doc_id", "th", F.col("at").alias("s"),
                          (F.col("at") + F.col("n") + (width - 1)).alias("e"))
    # One range for each class: all its windows hold the anchor, so their union has no gap.
    reach = spans.groupBy("key", "fp").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    alone = each.where("c = 1").select("key", "fp", "first")
    part = alone.join(reach, ["key", "fp"]).select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th"),
        (F.col("first.at") + F.col("s")).alias("s"), (F.col("first.at") + F.col("e")).alias("e"))
    return whole.unionByName(part)


def _remaining(text: np.ndarray, spans: pa.Scalar) -> tuple[np.ndarray, int]:
    """Bytes outside the ranges, and the number of maximal removed runs."""
    if not spans.is_valid:
        return text, 0
    starts, ends = spans.values.flatten()
    gone = A.covered(len(text), np.asarray(starts), np.asarray(ends))
    return text[~gone], int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = A.texts_of(batch.column(1))
        both = [_remaining(data[at[i]:at[i + 1]], batch.column(2)[i]) for i in range(batch.num_rows)]
        total = np.diff(at)
        kept = np.array([len(k) for k, _ in both], np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total), pa.array(total - kept), pa.array([n for _, n in both], pa.int64()),
             pa.array([k.tobytes() for k, _ in both], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame, width: int = 400, **options) -> DataFrame:
    """Every document without its repeated bytes: doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs) and kept (remaining bytes)."""
    marked = R.with_spans(docs.select("doc_id", "text"), repeated_spans(R.identified(docs), width, **options))
    kind = dict(docs.dtypes)["doc_id"]
    return marked.mapInArrow(
        _kept_batches, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def _cut_batches(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = A.texts_of(batch.column(at))
            spans = batch.column(batch.num_columns - 1)
            texts = [_remaining(data[ends[i]:ends[i + 1]], spans[i])[0].tobytes().decode(errors="ignore")
                     for i in range(batch.num_rows)]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])
    return run


def cut_repeats(docs: DataFrame, width: int = 400, **options) -> DataFrame:
    """``docs``, all columns, with the repeated bytes cut from its texts (a
    character of which a byte is cut goes as a whole; null becomes empty);
    ``n_chars``, if there is one, follows."""
    marked = R.with_spans(docs, repeated_spans(R.identified(docs), width, **options))
    out = marked.mapInArrow(_cut_batches(docs.columns.index("text")), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
