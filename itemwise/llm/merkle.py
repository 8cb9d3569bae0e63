"""Merkle manifest of a dataset as a SHA midstate tree (operator 12).

Every row is a leaf, the SHA-256 of its fields.  In each group (a source) the
leaves ascend by key; while several nodes remain, every three neighbours (the
last run may be shorter) become the hash of their digests, and what remains is
the group's subroot.  The subroots, ordered by group, become the root in the
same way.

A parent keeps the hash state from before each of its child slots.  A digest's
text fills exactly one SHA-256 block, so such a state is 32 bytes that a table
can hold.  To fold a replaced child, the state before its slot is resumed with
the replacement and the siblings to its right; those to its left are never
hashed again.

Spark cuts a tree into blocks of 3**LEVELS neighbours.  ``build`` makes all
levels of a block in one task, whole blocks at a time in one array, keeps for
every leaf what folding needs inside its block, and goes on with the block
roots: a round is LEVELS levels, so four rounds hold 10**11 rows.  Positions
come from range partitions, so a source of any size is spread over all tasks.
The states and siblings above a block are joined to its rows at the end.

Input handling: a null field counts as ``-``, any other as its UTF-8 byte
count, ``:`` and its text; null keys come first, rows that repeat a key follow
by their leaf digest, and wholly equal rows are leaves of their own; a null
group is a group and comes first; an empty table gives no rows; columns that
are not named as fields are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemwise.functions.prefix import dense_positions
from itemwise.llm import sha256
from itemwise.session import write_scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
LEVELS = 6
CHUNK_ROWS = 20_000          # rows whose blocks a task works on together

_STEP = pa.struct([("state", pa.binary()), ("left", pa.int32()), ("siblings", pa.list_(pa.binary()))])
_PATH = "array<struct<state: binary, left: int, siblings: array<binary>>>"


# --- leaves --------------------------------------------------------------------

def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(f) for f in fields]), 256))


# --- levels of whole blocks ------------------------------------------------------

def _level(nodes: np.ndarray, slot: np.ndarray):
    """Parents of nodes (runs that start at slot 0) and, for each node, its
    parent's number and the step that folds it: (state before its slot, slot,
    number of siblings, first and second sibling)."""
    parent = np.cumsum(slot == 0) - 1
    first = np.flatnonzero(slot == 0)
    count = np.bincount(parent, minlength=len(first))
    blocks = sha256.hex_blocks(nodes)
    states = [sha256.start(len(first))]
    for k in range(FAN):
        state = states[-1].copy()
        at = np.flatnonzero(count > k)
        state[:, at] = sha256.absorb(state[:, at], blocks[:, first[at] + k])
        states.append(state)
    # A parent with fewer children keeps its state from the last one on.
    digests = sha256.finish(states[FAN], count)
    before = np.stack(states[:FAN])[slot, :, parent].T
    near = first[parent]
    last = len(slot) - 1
    siblings = [nodes[:, np.minimum(near + (slot == 0), last)],
                nodes[:, np.minimum(near + 1 + (slot <= 1), last)]]
    return digests, parent, (before, slot, count[parent] - 1, siblings)


def _fold(step, child: np.ndarray) -> np.ndarray:
    """The parent's digest with ``child`` in the node's slot."""
    state, left, others, siblings = step
    state = sha256.absorb(state, sha256.hex_blocks(child))
    for k, sibling in enumerate(siblings):
        at = np.flatnonzero((k >= left) & (k < others))
        state[:, at] = sha256.absorb(state[:, at], sha256.hex_blocks(sibling[:, at]))
    return sha256.finish(state, others + 1)


def _prove(step, proof: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The running hash of all siblings so far, and their number."""
    _, _, others, siblings = step
    proof = proof.copy()
    for k, sibling in enumerate(siblings):
        at = np.flatnonzero(k < others)
        proof[:, at] = sha256.absorb(proof[:, at], sha256.hex_blocks(sibling[:, at]))
    return proof, blocks + others


def _climb(digests: np.ndarray, starts: np.ndarray, whole: np.ndarray, levels: int) -> Iterator[tuple]:
    """Levels of several blocks at once.  ``whole`` blocks have exactly ``levels``
    levels, others end at their single node.  Yields for each level the leaves
    that take part and their step, at last None and the blocks' roots."""
    sizes = np.diff(np.append(starts, digests.shape[1]))
    block = np.repeat(np.arange(len(starts)), sizes)
    nodes, at = digests, np.arange(digests.shape[1])      # at: a leaf's node
    for _ in range(levels):
        sizes = np.bincount(block, minlength=len(starts))
        active = (whole | (sizes > 1))[block]
        if not active.any():
            break
        place = np.arange(len(block)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ours = np.flatnonzero(active)
        parents, parent, step = _level(nodes[:, ours], (place % FAN)[ours])
        number = np.full(len(block), -1)
        number[ours] = np.arange(len(ours))
        leaves = np.flatnonzero(active[at])
        mine = number[at[leaves]]
        before, slot, others, siblings = step
        yield leaves, (before[:, mine], slot[mine], others[mine], [s[:, mine] for s in siblings])
        rest = np.flatnonzero(~active)
        up = np.zeros(parents.shape[1], np.int64)
        up[parent] = block[ours]
        owner = np.concatenate((up, block[rest]))
        order = np.argsort(owner, kind="stable")
        to = np.empty(len(order), np.int64)
        to[order] = np.arange(len(order))
        moved = np.empty(len(block), np.int64)
        moved[ours], moved[rest] = to[parent], to[len(up) + np.arange(len(rest))]
        at = moved[at]
        nodes = np.concatenate((parents, nodes[:, rest]), axis=1)[:, order]
        block = owner[order]
    yield None, nodes


def _digests(column) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return sha256.from_bytes(np.frombuffer(raw, np.uint8).reshape(-1, 32))


def _binary(words: np.ndarray) -> pa.Array:
    raw = sha256.to_bytes(words)
    return pa.Array.from_buffers(pa.binary(), len(raw), [
        None, pa.py_buffer((np.arange(len(raw) + 1) * 32).astype(np.int32)), pa.py_buffer(raw.tobytes())])


def _whole_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that end with a block, with their blocks' first rows."""
    def starts_of(table):
        new = np.zeros(len(table), bool)
        new[:1] = True
        trees, blocks = table["tree"].combine_chunks(), table["block"].to_numpy()
        new[1:] = blocks[1:] != blocks[:-1]
        new[1:] |= np.asarray(pc.not_equal(trees[1:], trees[:-1]).to_numpy(zero_copy_only=False), bool)
        return np.flatnonzero(new)

    held = None
    for batch in batches:
        got = pa.Table.from_batches([batch])
        held = got if held is None else pa.concat_tables([held, got])
        if len(held) >= rows:
            starts = starts_of(held)
            if len(starts) > 1:
                yield held.slice(0, starts[-1]), starts[:-1]
                held = held.slice(starts[-1])
    if held is not None and len(held):
        yield held, starts_of(held)


def _roots(table: pa.Table, starts: np.ndarray, roots: np.ndarray, whole: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """A row for each block; ``sole`` where the block is its whole tree."""
    columns = {"tree": table["tree"].take(starts).combine_chunks(), "block": table["block"].take(starts).combine_chunks(),
               "digest": _binary(roots), "sole": pa.array(~whole)}
    return _batch(columns, names, len(starts))


def _batch(columns: dict, names: list[str], rows: int) -> pa.RecordBatch:
    types = {"tree": pa.string(), "block": pa.int64(), "digest": pa.binary(), "sole": pa.bool_(),
             "key": pa.int64(), "leaf": pa.binary(), "folded": pa.binary(), "proof": pa.binary(),
             "n_proof": pa.int32(), "position": pa.int64(), "name": pa.string(), "path": pa.list_(_STEP)}
    arrays = [columns[n].cast(types[n]) if n in columns and n != "path" else columns.get(n, pa.nulls(rows, types[n]))
              for n in names]
    return pa.RecordBatch.from_arrays(arrays, names)


def _whole(table: pa.Table, starts: np.ndarray, levels: int) -> np.ndarray:
    """Blocks that have all their levels: all but a first one that is not full."""
    sizes = np.diff(np.append(starts, len(table)))
    return (table["block"].to_numpy()[starts] > 0) | (sizes == FAN ** levels)


LEAVES = "tree string, block long, digest binary, sole boolean, key long, leaf binary, folded binary, proof binary, n_proof int"
NODES = f"tree string, block long, digest binary, sole boolean, position long, name string, path {_PATH}"


_LEAF_NAMES = ["tree", "block", "digest", "sole", "key", "leaf", "folded", "proof", "n_proof"]
_NODE_NAMES = ["tree", "block", "digest", "sole", "position", "name", "path"]


def _leaf_blocks(levels: int, chunk_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_blocks(batches, chunk_rows):
            whole = _whole(table, starts, levels)
            leaves, folded = _digests(table["leaf"]), _digests(table["candidate"])
            proof, blocks = sha256.start(len(table)), np.zeros(len(table), np.int64)
            for at, step in _climb(leaves, starts, whole, levels):
                if at is None:
                    yield _roots(table, starts, step, whole, _LEAF_NAMES)
                    break
                folded[:, at] = _fold(step, folded[:, at])
                proof[:, at], blocks[at] = _prove(step, proof[:, at], blocks[at])
            columns = {n: table[n].combine_chunks() for n in ("tree", "block", "key", "leaf")}
            columns |= {"folded": _binary(folded), "proof": _binary(proof), "n_proof": pa.array(blocks)}
            out = _batch(columns, _LEAF_NAMES, len(table))
            for s in range(0, len(table), 8192):
                yield out.slice(s, 8192)
    return run


def _node_blocks(levels: int, chunk_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_blocks(batches, chunk_rows):
            whole = _whole(table, starts, levels)
            paths: list[list[dict]] = [[] for _ in range(len(table))]
            for at, step in _climb(_digests(table["digest"]), starts, whole, levels):
                if at is None:
                    yield _roots(table, starts, step, whole, _NODE_NAMES)
                    break
                state, left, others, siblings = step
                state, siblings = sha256.to_bytes(state), [sha256.to_bytes(s) for s in siblings]
                for k, leaf in enumerate(at.tolist()):
                    paths[leaf].append({"state": state[k].tobytes(), "left": int(left[k]),
                                        "siblings": [siblings[j][k].tobytes() for j in range(int(others[k]))]})
            columns = {n: table[n].combine_chunks() for n in ("tree", "position", "name")}
            columns["path"] = pa.array(paths, pa.list_(_STEP))
            out = _batch(columns, _NODE_NAMES, len(table))
            for s in range(0, len(table), 1024):
                yield out.slice(s, 1024)
    return run


def _above(position: str, size: int) -> Column:
    return F.floor(F.col(position) / F.lit(size)).cast("long")


def _in_blocks(rows: DataFrame, levels: int) -> DataFrame:
    return (rows.withColumn("block", _above("position", FAN ** levels))
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "position"))


# --- the tree ------------------------------------------------------------------

def _rounds(nodes: DataFrame, name: str, levels: int, chunk_rows: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds over nodes (tree, position, name, digest): the path table of each
    round, and the trees' ends (tree, digest)."""
    paths, ends = [], []
    while True:
        made = write_scratch(_in_blocks(nodes, levels).mapInArrow(_node_blocks(levels, chunk_rows), NODES), name)
        paths.append(made.where("path IS NOT NULL").select("tree", "position", "name", "path"))
        roots = made.where("sole IS NOT NULL")
        ends.append(roots.where("sole").select("tree", "digest"))
        nodes = roots.where("NOT sole").select("tree", F.col("block").alias("position"),
                                               F.lit(None).cast("string").alias("name"), "digest")
        if nodes.isEmpty():
            break
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return paths, out


def _with_paths(rows: DataFrame, paths: list[DataFrame], place: str, levels: int) -> DataFrame:
    """Appends to ``path`` the steps of each round; a tree that ended earlier
    has none in later rounds."""
    for k, path in enumerate(paths):
        step = path.select(F.col("tree").alias("__tree"), F.col("position").alias("__position"),
                           F.col("path").alias("__path"))
        at = _above(place, FAN ** (levels * k))
        rows = (rows.join(step, (F.col("tree") == F.col("__tree")) & (at == F.col("__position")), "left")
                .withColumn("path", F.when(F.col("__path").isNull(), F.col("path"))
                            .otherwise(F.concat("path", "__path")))
                .drop("__tree", "__position", "__path"))
    return rows


def _nested(paths: pa.ListArray):
    """Flat arrays of the rows' paths: first step and steps of each row, and
    each step's state, slot, siblings' first place and number."""
    sizes = paths.value_lengths().to_numpy()
    steps = paths.flatten()
    others = steps.field("siblings").value_lengths().to_numpy()
    flat = steps.field("siblings").flatten()
    return (np.cumsum(sizes) - sizes, sizes, _digests(steps.field("state")), steps.field("left").to_numpy().astype(np.int64),
            np.cumsum(others) - others, others, _digests(flat))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds each row's block root on through the path above its block."""
    for batch in batches:
        first, sizes, states, left, near, others, siblings = _nested(batch["path"])
        folded, proof = _digests(batch["folded"]), _digests(batch["proof"])
        blocks = batch["n_proof"].to_numpy().astype(np.int64)
        for k in range(int(sizes.max(initial=0))):
            at = np.flatnonzero(sizes > k)
            s = first[at] + k
            last = max(siblings.shape[1] - 1, 0)
            both = [siblings[:, np.minimum(near[s] + j, last)] if siblings.shape[1]
                    else np.zeros((8, len(s)), np.uint32) for j in range(FAN - 1)]
            step = (states[:, s], left[s], others[s], both)
            folded[:, at] = _fold(step, folded[:, at])
            proof[:, at], blocks[at] = _prove(step, proof[:, at], blocks[at])
        yield pa.RecordBatch.from_arrays(
            [batch["key"], batch["leaf"], batch["subroot"], batch["root"], _binary(sha256.finish(proof, blocks)),
             _binary(folded)], ["key", "leaf", "subroot", "root", "proof", "folded_root"])


def manifest(docs: DataFrame, candidate: dict[str, Column] | None = None, key: str = "doc_id",
             group: str = "source", fields: Sequence[str] = FIELDS,
             levels: int = LEVELS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(key, leaf, subroot, root, proof, folded_root) of every row, digests as
    binary.  ``candidate`` names fields whose claimed contents are checked:
    ``folded_root`` is the root with the leaf of those contents in place."""
    now = {f: F.col(f) for f in fields}
    claimed = now | (candidate or {})
    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        leaf_digest([now[f] for f in fields]).alias("leaf"),
        leaf_digest([claimed[f] for f in fields]).alias("candidate"),
        F.monotonically_increasing_id().alias("row"))     # tells wholly equal rows apart
    placed = dense_positions(rows, [F.asc_nulls_first("key"), F.asc("leaf"), F.asc("row")], ["tree"])
    made = write_scratch(_in_blocks(placed, levels).select("tree", "block", "key", "leaf", "candidate")
                         .mapInArrow(_leaf_blocks(levels, chunk_rows), LEAVES), "merkle-leaves")
    leaves, roots = made.where("sole IS NULL"), made.where("sole IS NOT NULL")

    nodes = roots.where("NOT sole").select("tree", F.col("block").alias("position"),
                                           F.lit(None).cast("string").alias("name"), "digest")
    paths, ends = _rounds(nodes, "merkle-nodes", levels, chunk_rows)
    subroots = roots.where("sole").select("tree", "digest").unionByName(ends)

    top = dense_positions(subroots, [F.asc("tree")]).select(
        F.lit("").alias("tree"), "position", F.col("tree").alias("name"), "digest")
    above, end = _rounds(top, "merkle-top", levels, chunk_rows)
    sources = above[0].select(F.col("name"), "position", "path")
    sources = _with_paths(sources.select("*", F.lit("").alias("tree"), _above("position", FAN ** levels).alias("__at")),
                          above[1:], "__at", levels)
    sources = (sources.select("name", F.col("path").alias("upper"))
               .join(subroots.select(F.col("tree").alias("name"), F.col("digest").alias("subroot")), "name"))

    blocks = roots.select("tree", "block", F.array().cast(_PATH).alias("path"))
    blocks = _with_paths(blocks, paths, "block", levels).join(sources, F.col("tree") == F.col("name"))
    root = end.first()      # one row, none for an empty table
    blocks = write_scratch(blocks.select("tree", "block", F.concat("path", "upper").alias("path"), "subroot",
                                         F.lit(bytes(root["digest"]) if root else None).cast("binary").alias("root")),
                           "merkle-paths")
    return (leaves.select("tree", "block", "key", "leaf", "folded", "proof", "n_proof")
            .join(blocks, ["tree", "block"])
            .select("key", "leaf", "folded", "proof", "n_proof", "path", "subroot", "root")
            .mapInArrow(_finish, "key long, leaf binary, subroot binary, root binary, proof binary, folded_root binary"))
