"""MinHash near-dedup with DartMinHash signatures (operator 1).

A document is the weighted set of its shingles of five words; the weight is
the number of times a shingle occurs.  The region of an element is its weight
times the rank axis, cut into unit cells; a hash gives each cell a Poisson
number of darts, and each dart a rank and a coordinate.  A document throws
the darts of its own cells with rank below theta = darts / weight and keeps
the earliest of each coordinate, so two documents agree in a coordinate with
the probability of their weighted Jaccard similarity.  Bands of coordinates
name buckets; each bucket links its members to two leaders, pairs are sifted
by a sketch of the signature and then verified exactly on the shingles, and
the verified links' connected components are the classes.

Equal texts are one node from the start, so copies are never paired.  Bucket
members are first compared with two leaders that differ from bucket to
bucket, which joins a group of any size with linear work.  A last round
compares all members of a bucket that are still in different components, in
tiles, so that every pair that shares a bucket was compared or is in one
class: only members that are unlike each other cost a comparison for each
pair.

Input handling: texts without words (null, empty, white space) are classes
of their own; a text of fewer than five words is one shingle; ``class_id`` is
the least doc_id of the class (null only if all are null); rows that repeat
a doc_id are separate documents; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemwise.llm import arrays as A
from itemwise.llm.graph import components
from itemwise.session import release_shuffles, small_batches, write_scratch

_U = np.uint64
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS
DARTS = COORDINATES * (np.log(COORDINATES) + 2)   # expected darts of a document
SKETCH = 64          # coordinates, of 8 bits, in the sketch that sifts pairs
# Four standard deviations of the sketch's estimate below the similarity.
SIFT = SIMILARITY - 4 * float(np.sqrt(SIMILARITY * (1 - SIMILARITY) / SKETCH))
TILE = 256           # members of a bucket that meet the members of another tile in one step
PAIRS = 1 << 16      # pairs of a tile that are sifted at once
_RANK_BITS = 21
_POISSON = np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, j + 1))) for j in range(12)])


def units(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the unit-weight elements (shingle, occurrence number) of the
    texts of a slice, in text order, and the offsets of the texts."""
    s, e, words = A.word_spans(data, offsets)
    count = np.diff(words)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    start = A.concat_ranges(words[:-1], n)
    doc = np.repeat(np.arange(len(n)), n)
    sums = A.prefix_sums(A.word_hashes(data, s, e))
    gram = A.span_hashes(sums, start, np.minimum(start + size, words[1:][doc]))
    mark = A.mix(gram + A.mix(doc.astype(_U) + _U(1)))
    order = np.argsort(mark)
    ordered = mark[order]
    again = np.concatenate(([False], ordered[1:] == ordered[:-1])) if len(order) else np.zeros(0, bool)
    if again.any():
        first = np.flatnonzero(~again)
        number = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        times = np.zeros(len(order), _U)
        times[order] = number.astype(_U)
        gram = np.where(times > 0, A.mix(gram + times * _U(0xA0761D6478BD642F)), gram)
    return gram, np.concatenate(([0], np.cumsum(n)))


def signatures(gram: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of COORDINATES dart names (32 bits) for each text; 0: no dart."""
    n = np.diff(offsets)
    theta = DARTS / np.maximum(n, 1)
    cells = np.where(n > 0, np.ceil(theta), 0).astype(np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    per = cells[doc]
    unit = np.repeat(gram, per)
    cell = A.concat_ranges(np.zeros(len(per), np.int64), per).astype(_U)
    region = A.mix(unit + cell * _U(0xE7037ED1A0B428DB))
    thrown = np.searchsorted(_POISSON, (region >> _U(11)).astype(np.float64) / 2.0 ** 53)
    number = A.concat_ranges(np.zeros(len(thrown), np.int64), thrown).astype(_U)
    dart = A.mix(np.repeat(region, thrown) + (number + _U(1)) * _U(0x8EBC6AF09C88C6E3))
    whose = np.repeat(np.repeat(doc, per), thrown)
    rank = (np.repeat(cell, thrown) << _U(_RANK_BITS)) | (dart >> _U(64 - _RANK_BITS))
    use = rank.astype(np.float64) < theta[whose] * 2.0 ** _RANK_BITS
    dart, whose, rank = dart[use], whose[use], rank[use]
    coordinate = ((dart & _U(0xFFFFFFFF)) * _U(COORDINATES)) >> _U(32)
    name = (A.mix(dart) >> _U(32)) | _U(1)
    none = np.iinfo(np.uint64).max
    best = np.full(len(n) * COORDINATES, none, _U)
    np.minimum.at(best, whose * COORDINATES + coordinate.astype(np.int64), (rank << _U(32)) | name)
    return np.where(best == none, _U(0), best & _U(0xFFFFFFFF)).reshape(len(n), COORDINATES)


def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = A.texts_of(batch.column(2))
        for lo, hi in A.slices(at):
            gram, off = units(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
            sig = signatures(gram, off)
            band = np.full((hi - lo, BANDS), 0, _U)
            grouped = sig.reshape(hi - lo, BANDS, ROWS)
            for j in range(ROWS):
                band = A.mix(band + grouped[:, :, j] + _U(j + 1))
            band = A.mix(band + np.arange(BANDS, dtype=_U)) | _U(1)
            band[(grouped == 0).any(axis=2)] = 0
            has = np.diff(off) > 0
            sketch = (sig[:, :SKETCH] & _U(0xFE)) >> _U(1) | ((sig[:, :SKETCH] >> _U(8)) & _U(1)) << _U(7)
            raw = np.ascontiguousarray(sketch.astype(np.uint8))
            keep = pa.array(np.flatnonzero(has) + lo)
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(0, int(has.sum()) * BANDS + 1, BANDS, dtype=np.int32)),
                pa.array(band[has].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).cast(pa.int64()).take(keep), bands,
                 pa.array([raw[i].tobytes() for i in np.flatnonzero(has)], pa.binary())],
                ["node", "doc_id", "bands", "sketch"])


def _sift_batches(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH)
                    for i in (2, 3))
            alike = (x == y).mean(axis=1)
            keep = pa.array(np.flatnonzero(alike >= least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep), pa.array(alike).take(keep)],
                ["a", "b", "alike"])
    return run


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = A.texts_of(batch.column(1))
        for lo, hi in A.slices(at):
            gram, off = units(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
            raw = [np.sort((gram[off[i]:off[i + 1]] >> _U(32)).astype(np.uint32)).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(raw, pa.binary())], ["node", "units"])


def _similar(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common >= least * (len(both) - common)


def _verify_batches(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(j)[i].as_buffer(), np.uint32) for j in (2, 3))
                if _similar(x, y, least):
                    keep.append(i)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])
    return run


def _tile_links(rows: pa.Table, sift: float, least: float) -> list[tuple[int, int]]:
    """Verified links between the components of each cell's rows, which are
    sorted by (band, x, y, side); a pair counts in its first common band."""
    band, x, y, side, node, root = (rows.column(i).to_numpy() for i in range(6))
    bands = rows.column(6).combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    sketch = np.frombuffer(b"".join(rows.column(7).to_pylist()), np.uint8).reshape(-1, SKETCH)
    own = x == y
    new = np.concatenate(([True], (band[1:] != band[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    head = np.flatnonzero(new)
    width = np.diff(np.append(head, len(band)))
    end = np.repeat(head + width, width)
    across = end - np.repeat(np.add.reduceat(side.astype(np.int64), head), width)
    start = np.where(own, np.arange(len(band)) + 1, across)
    count = np.where(own | (side == 0), end - start, 0)
    done = np.cumsum(count)
    units = rows.column(8)
    part: dict[int, np.ndarray] = {}
    up: dict[int, int] = {}

    def top(r: int) -> int:
        while up.get(r, r) != r:
            r = up[r]
        return r

    def read(i: int) -> np.ndarray:
        if i not in part:
            part[i] = np.frombuffer(units[i].as_buffer(), np.uint32)
        return part[i]

    links, lo = [], 0
    while lo < len(band):
        hi = max(int(np.searchsorted(done, (done[lo - 1] if lo else 0) + PAIRS, "right")), lo + 1)
        i = np.repeat(np.arange(lo, hi), count[lo:hi])
        j = A.concat_ranges(start[lo:hi], count[lo:hi])
        lo = hi
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        alike = (sketch[i] == sketch[j]).mean(axis=1) >= sift
        i, j = i[alike], j[alike]
        first = ((bands[i] == bands[j]) & (bands[i] != 0)).argmax(axis=1)
        here = bands[i, first] == band[i]
        for a, b in zip(i[here].tolist(), j[here].tolist()):
            ra, rb = top(int(root[a])), top(int(root[b]))
            if ra != rb and _similar(read(a), read(b), least):
                up[ra] = rb
                links.append((int(node[a]), int(node[b])))
    return links


def _tile_batches(sift: float, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: pa.Table) -> pa.RecordBatch:
            links = _tile_links(rows, sift, least)
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
            if not rows.num_rows:
                continue
            cell = [rows.column(i).to_numpy() for i in range(3)]
            last = np.logical_and.reduce([c == c[-1] for c in cell])
            cut = int(np.flatnonzero(last)[0])      # the last cell may go on in the next batch
            if cut:
                yield out(rows.slice(0, cut).combine_chunks())
            rest = rows.slice(cut)
        if rest is not None:
            yield out(rest.combine_chunks())
    return run


def _mixed(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, node, root): members of the buckets that hold several
    components and more pairs than those with the two leaders."""
    rooted = nodes.join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "bands")
    members = rooted.select("node", "root", F.explode("bands").alias("band")).where("band != 0")
    several = members.groupBy("band").agg(
        F.count(F.lit(1)).alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("c > 3 AND lo < hi")
    return members.join(several.select("band"), "band").select("band", "node", "root")


def _cells(mixed: DataFrame) -> DataFrame:
    """A row (band, x, y, side) of a member for each cell, a pair of tiles of
    its bucket.  Members of the bucket's largest component (tiles below 0)
    meet only the others; the others meet all."""
    sizes = (mixed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("band")
             .agg(F.sum("n").alias("c"), F.max("n").alias("most"), F.max_by("root", "n").alias("top")))
    tiles = sizes.select("band", "top", F.ceil(F.col("most") / TILE).cast("int").alias("nt"),
                         F.ceil((F.col("c") - F.col("most")) / TILE).cast("int").alias("no"))
    in_top = F.col("root") == F.col("top")
    tile = F.pmod(F.xxhash64("node", "band"), F.when(in_top, F.col("nt")).otherwise(F.col("no"))).cast("int")

    def cell(x, y, side):
        return F.struct(x.alias("x"), y.alias("y"), side.cast("int").alias("side"))

    def each(n, make):
        return F.transform(F.sequence(F.lit(0), F.col(n) - 1), make)

    t = F.col("tile")
    low = each("no", lambda j: cell(-1 - t, j, F.lit(0)))
    rest = F.concat(each("no", lambda j: cell(F.least(t, j), F.greatest(t, j), t > j)),
                    each("nt", lambda k: cell(-1 - k, t, F.lit(1))))
    placed = mixed.join(tiles, "band").withColumn("tile", tile)
    placed = placed.withColumn("cell", F.explode(F.when(in_top, low).otherwise(rest)))
    return placed.select("band", "cell.x", "cell.y", "cell.side", "node", "root")


def _candidate_pairs(nodes: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: bucket members and the bucket's two leaders."""
    members = nodes.select("node", F.explode("bands").alias("band")).where("band != 0")
    order = F.xxhash64("node", "band")
    leaders = (members.groupBy("band")
               .agg(F.count(F.lit(1)).alias("c"), F.min_by("node", order).alias("l1"),
                    F.max_by("node", order).alias("l2")).where("c > 1"))
    pairs = members.join(leaders, "band").select("node", F.explode(F.array("l1", "l2")).alias("leader"))
    return (pairs.where("node != leader")
            .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct())


def _with_both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    left = values.select(F.col("node").alias("a"), F.col(column).alias("x"))
    right = values.select(F.col("node").alias("b"), F.col(column).alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    la = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    lb = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    joined = pairs.join(la, "a", "left").join(lb, "b", "left")
    return joined.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b", "alike")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, class_id, members, root, leads, lead_id): the class of every
    distinct text, its least doc_id, its number of documents, and whether
    its first document (``lead_id``) has this text.  ``docs``: node, doc_id,
    text."""
    spark = docs.sparkSession
    sigs = docs.mapInArrow(_signature_batches, "node long, doc_id long, bands array<long>, sketch binary")
    nodes = write_scratch(
        sigs.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("c"),
                                 F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")
    release_shuffles(spark)
    pairs = _with_both(_candidate_pairs(nodes), nodes, "sketch").mapInArrow(
        _sift_batches(SIFT + similarity - SIMILARITY), "a long, b long, alike double")
    pairs = write_scratch(pairs, "pairs")
    release_shuffles(spark)

    def shingled(some: DataFrame) -> DataFrame:
        wanted = some.join(nodes.select("node", F.col("doc_id").alias("one")), "node")
        texts = docs.join(wanted, "node").where(F.col("doc_id").eqNullSafe(F.col("one"))).select("node", "text")
        return write_scratch(texts.mapInArrow(_unit_batches, "node long, units binary")
                             .dropDuplicates(["node"]), "shingles")

    shingles = shingled(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    release_shuffles(spark)

    def verified(part: DataFrame) -> DataFrame:
        both = _with_both(part, shingles, "units")
        return both.mapInArrow(_verify_batches(similarity), "a long, b long")

    # First the likeliest partner of each text, then only what is still apart.
    best = pairs.groupBy("b").agg(F.max_by("a", "alike").alias("a"))
    links = write_scratch(verified(best), "near")
    labels = write_scratch(components(links), "labels")
    more = write_scratch(verified(_apart(pairs, labels)), "near")
    links = links.unionByName(more)
    labels = write_scratch(components(links), "labels")
    # Then what shares a bucket, led by others, and is still apart.
    mixed = write_scratch(_mixed(nodes, labels), "mixed")
    release_shuffles(spark)
    if not mixed.isEmpty():
        some = mixed.select("node").distinct()
        units_of = shingles.join(some, "node", "left_semi").unionByName(
            shingled(some.join(shingles, "node", "left_anti")))
        rows = (_cells(mixed).join(nodes.select("node", "bands", "sketch"), "node").join(units_of, "node")
                .select("band", "x", "y", "side", "node", "root", "bands", "sketch", "units")
                .repartition("band", "x", "y").sortWithinPartitions("band", "x", "y", "side"))
        last = rows.mapInArrow(_tile_batches(SIFT + similarity - SIMILARITY, similarity), "a long, b long")
        last = write_scratch(last, "near")
        release_shuffles(spark)
        if not last.isEmpty():
            labels = components(links.unionByName(last))
    rooted = nodes.join(labels, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "doc_id", "c")
    rooted = write_scratch(rooted, "rooted")
    release_shuffles(spark)
    groups = rooted.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.sum("c").alias("members"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("first"))
    return rooted.select("node", "root").join(groups, "root").select(
        "node", "class_id", "members", "root",
        (F.col("first.node") == F.col("node")).alias("leads"), F.col("first.doc_id").alias("lead_id"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """All columns of ``docs`` and class_id, members (documents of the class)
    and kept: exactly one document of each class, the first by doc_id."""
    small_batches(docs.sparkSession)
    named = docs.withColumn("__node", F.xxhash64("text"))
    found = classes(named.select(F.col("__node").alias("node"), F.col("doc_id").cast("long").alias("doc_id"), "text"),
                    similarity)
    renamed = {"node": "__node", "class_id": "__class", "members": "__members", "root": "__root",
               "leads": "__leads", "lead_id": "__lead"}
    joined = named.join(found.withColumnsRenamed(renamed), "__node", "left")
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("class_id", "members", "kept")]
    result = [*own, F.coalesce("__class", F.col("doc_id").cast("long")).alias("class_id"),
              F.coalesce("__members", F.lit(1)).alias("members")]
    alone = F.coalesce("__members", F.lit(1)) == 1
    leads = F.col("__leads") & F.col("doc_id").cast("long").eqNullSafe(F.col("__lead"))
    single = joined.where(alone).select(*result, F.lit(True).alias("kept"))
    others = joined.where(~alone & ~leads).select(*result, F.lit(False).alias("kept"))
    # One row a class, unless whole rows repeat: those alone are numbered.
    turn = F.row_number().over(Window.partitionBy("__root").orderBy("__node"))
    first = joined.where(~alone & leads).withColumn("__n", turn).select(*result, (F.col("__n") == 1).alias("kept"))
    return single.unionByName(others).unionByName(first)
