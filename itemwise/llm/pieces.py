"""Sampled SentencePiece segmentation and lossless decoding (operator 3).

A text is a lattice whose edges are vocabulary pieces.  Forward filtering
sums the weights of all paths to each node; backward sampling draws, from the
end, each edge with its share of the node's sum, so a segmentation comes up
with exactly its probability among all.  Draws are hashes of (seed, row key,
place), so a row always gets the same segmentation, on any executor.

A lattice falls apart where no piece can cross: before a line end, and before
a space unless some piece holds its neighbour and the space, as the pieces of
several spaces do; a run of spaces stays whole and with the word behind it.
Each distinct unit's lattice is built once a slice; all units of a slice are
filtered, and all their occurrences sampled, together.
Characters without a piece become byte pieces, and so do line ends and the
mark character itself, hence decoding gives every text back.

Weights: a model of type BPE scores its pieces by rank r; such a piece
weighs (r + 2) ** -alpha.  Unigram scores are log-probabilities; such a piece
weighs exp(alpha * score).

Input handling: null text is empty; empty texts are the space that leads
every text; the row key may be null and may repeat (equal keys and texts give
equal pieces); ``pieces`` and ``decoded`` are reserved column names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemwise.llm import arrays as A
from itemwise.session import small_batches

_U = np.uint64
MARK = 0x2581                # stands for a space in pieces
LITERAL_MARK = 0x110000      # the mark character as it occurs in a text
UNIT_BYTES = 5 << 19         # bytes of text whose units share one lattice
FALLBACK = -20.0             # log-weight of a character without a piece


class Vocabulary:
    """Pieces of a model as a trie in arrays, with weights and bytes."""

    _made: dict[tuple, Vocabulary] = {}

    @classmethod
    def get(cls, path: str, alpha: float) -> Vocabulary:
        if (path, alpha) not in cls._made:
            cls._made[path, alpha] = cls(path, alpha)
        return cls._made[path, alpha]

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes = np.full(256, -1, np.int64)
        raw: list[bytes] = []
        words: list[tuple[str, int]] = []
        scores = np.array([model.get_score(i) for i in range(size)])
        rank = bool((scores <= 0).all() and (scores == np.round(scores)).all())
        self.weight = -alpha * np.log(2.0 - np.maximum(scores, -1e8)) if rank else alpha * scores
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                raw.append(b"")
            else:
                raw.append(piece.replace(chr(MARK), " ").encode())
                if piece:
                    words.append((piece, i))
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte pieces, so it cannot encode every text")
        self.raw_at = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self._trie(words)
        # Characters that some piece holds right before a space or a line end.
        crossed: dict[str, set[str]] = {" ": set(), "\n": set()}
        for word, _ in words:
            for a, b in pairwise(word.replace(chr(MARK), " ")):
                if b in crossed:
                    crossed[b].add(a)
        self.only_runs = crossed[" "] <= {" "} and not crossed["\n"]
        self.cut = re.compile("|".join(
            (f"(?<![{re.escape(''.join(sorted(c)))}])" if c else "") + f"(?={b})" for b, c in crossed.items()))

    def _trie(self, words: list[tuple[str, int]]) -> None:
        """Edges node * 2**21 + character -> node, sorted; node -> piece or -1."""
        nodes: dict[int, int] = {}
        piece = [-1]
        for word, i in words:
            at = 0
            for ch in word:
                key = at << 21 | ord(ch)
                if key not in nodes:
                    nodes[key] = len(piece)
                    piece.append(-1)
                at = nodes[key]
            piece[at] = i
        self.edge = np.array(sorted(nodes), np.int64)
        self.to = np.array([nodes[k] for k in self.edge.tolist()], np.int64)
        self.piece = np.array(piece, np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = node << 21 | char
        at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
        return np.where(self.edge[at] == key, self.to[at], -1)


def units_of(vocabulary: Vocabulary, text: str) -> list[str]:
    """The text, with the space that leads it, cut where no piece can cross."""
    if not vocabulary.only_runs or "  " in text or text[:1] == " ":
        return [u for u in vocabulary.cut.split(" " + text) if u]
    first, *rest = text.split("\n")
    units = [" " + w for w in first.split(" ")]
    for line in rest:
        head, *words = line.split(" ")
        units.append("\n" + head)
        units += [" " + w for w in words]
    return units


class Lattice:
    """Lattices of many units (code points, offsets) and their path sums."""

    def __init__(self, vocabulary: Vocabulary, chars: np.ndarray, offsets: np.ndarray):
        n, size = len(chars), np.diff(offsets)
        small = np.int32 if n + len(size) < 1 << 31 else np.int64
        unit = np.repeat(np.arange(len(size), dtype=small), size)
        end = offsets[1:].astype(small)[unit]
        # Pieces from every position: walk the trie until nothing is left.
        node, begin, found = np.zeros(n, np.int64), np.arange(n, dtype=small), []
        length = 0
        single = np.zeros(n, bool)
        while len(begin):
            node = vocabulary.step(node, chars[begin + length])
            length += 1
            alive = node >= 0
            begin, node = begin[alive], node[alive]
            piece = vocabulary.piece[node].astype(small)
            hit = piece >= 0
            found.append((begin[hit], begin[hit] + small(length), piece[hit]))
            if length == 1:
                single[begin[hit]] = True
            go = begin + length < end[begin]
            begin, node = begin[go], node[go]
        # A character without a piece of its own is an edge of its bytes.
        bare = np.flatnonzero(~single).astype(small)
        found.append((bare, bare + small(1), -1 - bare))
        source, target, edge_piece = (np.concatenate([f[i] for f in found]) for i in range(3))
        del found, end, begin, node, single
        # Nodes: unit u has nodes offsets[u] + u .. offsets[u + 1] + u.
        target += unit[source]
        source += unit[source]
        order = np.argsort(target, kind="stable")
        source, target, edge_piece = source[order], target[order], edge_piece[order]
        del order
        weight = np.where(edge_piece >= 0, vocabulary.weight[np.maximum(edge_piece, 0)], FALLBACK)
        nodes = n + len(size)
        self.first = offsets[:-1] + np.arange(len(size))        # start node of a unit
        self.last = offsets[1:] + np.arange(len(size))          # end node
        self.source, self.vocabulary, self.chars = source, vocabulary, chars
        self.edge_at = np.concatenate(([0], np.cumsum(np.bincount(target, minlength=nodes))))
        # Forward filtering, by distance from the unit's start.
        alpha = np.full(nodes, -np.inf)
        alpha[self.first] = 0.0
        depth = target - np.repeat(self.first, size + 1)[target]
        longest = int(size.max(initial=0))
        by_depth = np.argsort(depth.astype(np.uint16 if longest < 1 << 16 else np.int64), kind="stable")
        bounds = np.concatenate(([0], np.cumsum(np.bincount(depth, minlength=longest + 1))))[1:]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            e = by_depth[a:b]
            if not len(e):
                continue
            value = alpha[source[e]] + weight[e]
            t = target[e]
            head = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            top = np.maximum.reduceat(value, head)
            width = np.diff(np.append(head, len(e)))
            alpha[t[head]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, width)), head))
        self.alpha = alpha
        # Shares of the edges into a node, summed up from the node's number.
        share = np.exp(alpha[source] + weight - alpha[target])
        total = np.concatenate(([0.0], np.cumsum(share)))
        inside = total[1:] - total[self.edge_at[target]]
        self.cumulative = target + np.minimum(inside, 1.0)
        # Tokens of an edge: its piece, or the bytes of its character.
        plain = edge_piece >= 0
        self.tokens_at = np.zeros(len(edge_piece) + 1, np.int64)
        count = np.ones(len(edge_piece), np.int64)
        lists = [self._bytes(int(chars[-1 - p])) for p in edge_piece[~plain].tolist()]
        count[~plain] = [len(x) for x in lists]
        np.cumsum(count, out=self.tokens_at[1:])
        self.tokens = np.empty(self.tokens_at[-1], np.int64)
        self.tokens[self.tokens_at[:-1][plain]] = edge_piece[plain]
        where = A.concat_ranges(self.tokens_at[:-1][~plain], count[~plain])
        self.tokens[where] = [t for x in lists for t in x]

    def _bytes(self, char: int) -> list[int]:
        text = b" " if char == MARK else chr(MARK if char == LITERAL_MARK else char).encode()
        return self.vocabulary.bytes[list(text)].tolist()

    def sample(self, units: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling of the occurrences ``units`` with random ``keys``:
        all tokens in order, and the number of tokens of each occurrence."""
        node, begin = self.last[units], self.first[units]
        who = np.arange(len(units))
        count = np.zeros(len(units), np.int64)
        steps = []
        turn = 0
        who, node = who[node > begin], node[node > begin]
        while len(who):
            draw = A.mix(keys[who] + _U(turn)) >> _U(11)
            place = node + draw.astype(np.float64) / 2.0 ** 53
            edge, last = self.edge_at[node], self.edge_at[node + 1] - 1
            over = np.flatnonzero((self.cumulative[edge] <= place) & (edge < last))
            while len(over):               # a node has few edges
                e = edge[over] + 1
                edge[over] = e
                over = over[(self.cumulative[e] <= place[over]) & (e < last[over])]
            size = self.tokens_at[edge + 1] - self.tokens_at[edge]
            count[who] += size
            steps.append((who, edge, count[who]))
            node = self.source[edge]
            turn += 1
            go = node > begin[who]
            who, node = who[go], node[go]
        out = np.empty(int(count.sum()), np.int64)
        ends = np.cumsum(count)
        for who, edge, done in steps:          # drawn from the end of each unit
            size = self.tokens_at[edge + 1] - self.tokens_at[edge]
            out[A.concat_ranges(ends[who] - done, size)] = self.tokens[A.concat_ranges(self.tokens_at[edge], size)]
        return out, count


def encode_texts(vocabulary: Vocabulary, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts in a row, and the offsets of the texts."""
    index: dict[str, int] = {}
    ids: list[int] = []
    per = []
    known = index.setdefault
    for text in texts:
        units = units_of(vocabulary, text)
        ids += [known(u, len(index)) for u in units]
        per.append(len(units))
    size = np.array([len(u) for u in index], np.int64)
    offsets = np.concatenate(([0], np.cumsum(size)))
    chars = np.frombuffer("".join(index).encode("utf-32-le"), np.uint32).astype(np.int64)
    chars[chars == MARK] = LITERAL_MARK
    chars[chars == ord(" ")] = MARK
    lattice = Lattice(vocabulary, chars, offsets)
    per = np.array(per)
    place = A.concat_ranges(np.zeros(len(per), np.int64), per).astype(_U)
    draw = A.mix(np.repeat(keys, per) + place * _U(0x9FB21C651E98DF25))
    tokens, count = lattice.sample(np.array(ids, np.int64), draw)
    ends = np.concatenate(([0], np.cumsum(count)))
    return tokens, ends[np.concatenate(([0], np.cumsum(per)))]


def decode_tokens(vocabulary: Vocabulary, tokens: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of token rows: bytes of the pieces without the leading space."""
    size = vocabulary.raw_at[tokens + 1] - vocabulary.raw_at[tokens]
    raw = vocabulary.raw[A.concat_ranges(vocabulary.raw_at[tokens], size)].tobytes()
    ends = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
    texts = (raw[a:b] for a, b in zip(ends[:-1], ends[1:]))
    return [(t[1:] if t[:1] == b" " else t).decode(errors="replace") for t in texts]


def _encode_batches(path: str, alpha: float, seed: int, at: int, key_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.get(path, alpha)
        for batch in batches:
            _, offsets = A.texts_of(batch.column(at))
            for lo, hi in A.slices(offsets, UNIT_BYTES):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(at).to_pylist()]
                keys = A.mix(np.asarray(part.column(key_at)).view(np.uint64) + _U(seed))
                tokens, ends = encode_texts(vocabulary, texts, keys)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tokens.astype(np.int32)))
                columns = [c for i, c in enumerate(part.columns) if i != key_at]
                names = [c for i, c in enumerate(part.schema.names) if i != key_at]
                yield pa.RecordBatch.from_arrays([*columns, lists], [*names, "pieces"])
    return run


def _decode_batches(path: str, alpha: float, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.get(path, alpha)
        for batch in batches:
            for lo in range(0, max(batch.num_rows, 1), 512):
                part = batch.slice(lo, 512)
                lists = part.column(at).fill_null([])
                size = np.asarray(lists.value_lengths())
                ends = np.concatenate(([0], np.cumsum(size)))
                texts = decode_tokens(vocabulary, np.asarray(lists.flatten()).astype(np.int64), ends)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])
    return run


def sample_encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
                  alpha: float = 1.0, seed: int = 7) -> DataFrame:
    """``docs`` with ``pieces``, a sampled segmentation of the text as piece
    ids; the row key seeds the draws.  ``model``: a SentencePiece file that
    every executor has."""
    small_batches(docs.sparkSession)
    keyed = docs.drop("pieces").withColumn("__key", F.xxhash64(F.col(key).cast("string")))
    schema = T.StructType([f for f in keyed.schema.fields if f.name != "__key"]
                          + [T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    names = keyed.columns
    return keyed.mapInArrow(_encode_batches(model, alpha, seed, names.index(text), names.index("__key")), schema)


def decode(frame: DataFrame, model: str, alpha: float = 1.0) -> DataFrame:
    """``frame`` with ``decoded``, the text of its ``pieces``."""
    frame = frame.drop("decoded")
    schema = T.StructType([*frame.schema.fields, T.StructField("decoded", T.StringType())])
    return frame.mapInArrow(_decode_batches(model, alpha, frame.columns.index("pieces")), schema)
