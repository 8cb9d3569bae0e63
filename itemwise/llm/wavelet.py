"""Token ids as wavelet-matrix shards (operator 5).

Documents in ascending doc_id order are encoded with a byte-level BPE of the
tokenizers library and written as shards; a task writes its own files and a
shard ends at a document once it holds ``shard_tokens``.  A shard is one
compressed file: a header, the documents' ids and lengths, and one bit plane
for each bit of a token id, highest first, in wavelet-matrix order, with
ranks every 512 bits.  It answers access, count (rank) and occurrence
(select) from the planes alone.

Equal words are common, so the library is asked once for each distinct word
of a task's cache.  A text is cut before every single space between two
characters that are not white space; there the pre-tokenizer always cuts too.
Texts with other white space next to a space are encoded whole.  New words of
ASCII and Latin letters are cut further, where the pre-tokenizer cuts, and the
library's model is asked once for each distinct piece.

Input handling: null text is empty and gives just the end id; rows that
repeat a doc_id follow each other, ordered by their text's hash; a null
doc_id comes first; an empty table gives no shards; other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm import files
from itemwise.session import scratch_path, small_batches, write_scratch

MAGIC = b"ITWM0001"
BLOCK = 512                  # bits between stored ranks
SHARD_TOKENS = 4_000_000
CACHE_WORDS = 1_600_000      # distinct words whose ids a worker keeps (some 200 bytes each)
END = 0
# Words of ASCII and of Latin letters, for which the classes below are those of
# the byte-level pre-tokenizer; any other word is left to the library whole.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
SAFE = re.compile(rf"[!-~{_LETTERS}\n]+")
PIECE = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[0-9]+| ?[!-/:-@\[-`{{-~]+|\n+(?!\S)|\n+")


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()


class Encoder:
    """Token ids of texts, as little-endian 16- or 32-bit bytes."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        size = self.tokenizer.get_vocab_size()
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.pieces: dict[str, bytes] = {}
        self._read(path)
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}

    @classmethod
    def get(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _read(self, path: str) -> None:
        """Whether ``PIECE`` cuts as the pre-tokenizer would: not where the
        tokenizer is no plain byte-level BPE.  Added tokens are never cut."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.safe = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space", True) and spec.get("normalizer") is None
                     and model.get("type") == "BPE" and not model.get("dropout"))
        self.added = [t["content"] for t in spec.get("added_tokens") or []]

    def _learn_pieces(self, known: dict, words: list[str], lead: str) -> None:
        """Ids of new words from those of their pieces; the library's model is
        asked once for each piece."""
        cut = [[lead + w] if w.isalpha() else PIECE.findall(lead + w) for w in words]
        if len(self.pieces) > CACHE_WORDS // 4:
            self.pieces.clear()
        new = list(set().union(*cut) - self.pieces.keys())
        ask, code = self.tokenizer.model.tokenize, "H" if self.type.itemsize == 2 else "I"

        def pack(*ids):
            return struct.pack(f"<{len(ids)}{code}", *ids)

        for piece in new:
            mapped = piece.encode().decode("latin-1").translate(BYTE_CHARS)
            self.pieces[piece] = pack(*[t.id for t in ask(mapped)])
        ids = self.pieces.__getitem__
        known.update((w, b"".join(map(ids, p))) for w, p in zip(words, cut))

    def _learn(self, known: dict, words: list[str], lead: str) -> None:
        """Ids of new words; None for those with white space at an end."""
        if self.safe:
            safe = [w for w in words if SAFE.fullmatch(w) and not any(t in w for t in self.added)
                    and w[0] != "\n" and w[-1] != "\n"]
            self._learn_pieces(known, safe, lead)
            words = [w for w in words if w not in known]
        plain = [w for w in words if w.isprintable() and w]    # printable: no white space but the space
        other = [w for w in words if not w.isprintable() or not w]
        fit = [w for w in other if w and not w[0].isspace() and not w[-1].isspace()]
        known.update(dict.fromkeys(other))
        if lead:
            # One call for all: each starts with the only space in it, so with
            # the only token that starts with a space.
            done = self.tokenizer.encode_batch_fast([lead + lead.join(plain)], add_special_tokens=False)
            ids = np.array(done[0].ids, self.type) if plain else np.zeros(0, self.type)
            at = np.flatnonzero(self.spaced[ids])
            if len(at) != len(plain):
                raise ValueError("the tokenizer joins words across a space")
            ends = (np.append(at, len(ids))[1:] * self.type.itemsize).tolist()
            raw = ids.tobytes()
            known.update(zip(plain, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        else:
            fit += plain
        done = self.tokenizer.encode_batch_fast([lead + w for w in fit], add_special_tokens=False)
        known.update((w, np.array(e.ids, self.type).tobytes()) for w, e in zip(fit, done))

    def _known(self, known: dict, words: list[str], lead: str) -> list[bytes | None]:
        """The ids of distinct words."""
        if len(known) > CACHE_WORDS:
            known.clear()
        new = [w for w in words if w not in known]
        if new:
            self._learn(known, new, lead)
        return list(map(known.__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Arrow numbers the words, so that Python sees the distinct ones of a
        call, and puts their ids in the places of the words."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = split.offsets.to_numpy()
        words = split.flatten()
        place = np.arange(len(words))
        head = np.zeros(len(words), bool)
        head[starts[:-1]] = True
        number, table = np.empty(len(words), np.int64), []
        for known, at, lead in ((self.first, place[head], ""), (self.later, place[~head], " ")):
            coded = words.take(pa.array(at)).dictionary_encode()
            number[at] = coded.indices.to_numpy() + len(table)
            table += self._known(known, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), lead)
        whole = np.array([ids is None for ids in table], bool)
        ids = pa.array([ids or b"" for ids in table], pa.large_binary()).take(pa.array(number))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(words) + 1][starts].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        out = [bytes(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        for i in np.flatnonzero(np.logical_or.reduceat(whole[number], starts[:-1])).tolist():
            ids = self.tokenizer.encode(texts[i], add_special_tokens=False).ids if texts[i] else []
            out[i] = np.array(ids, self.type).tobytes()
        return out


# --- the shard file ------------------------------------------------------------

def build_planes(tokens: np.ndarray, width: int) -> tuple[list[np.ndarray], list[int]]:
    """Bit planes (one boolean array for each bit, highest first) in
    wavelet-matrix order, and the number of zeros of each."""
    planes, zeros = [], []
    for b in range(width - 1, -1, -1):
        bits = (tokens & tokens.dtype.type(1 << b)) != 0
        low = tokens[~bits]
        tokens = np.concatenate((low, tokens[bits]))
        planes.append(np.packbits(bits, bitorder="little"))
        zeros.append(len(low))
    return planes, zeros


def write_shard(path: str, ids: list, lengths: np.ndarray, tokens: np.ndarray, vocabulary: int) -> None:
    width = max(int(vocabulary - 1).bit_length(), 1)
    planes, zeros = build_planes(tokens, width)
    pack = zstandard.ZstdCompressor(level=1).compress
    known = [i is not None for i in ids]
    parts = [pack(np.array([i if k else 0 for i, k in zip(ids, known)], "<i8").tobytes()),
             pack(np.packbits(np.array(known, bool)).tobytes()),
             pack(np.asarray(lengths, "<i8").tobytes())]
    for plane in planes:
        padded = np.zeros(-(-len(plane) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        padded[:len(plane)] = plane
        ones = np.bitwise_count(padded.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1)
        parts.append(pack(np.concatenate(([0], np.cumsum(ones))).astype("<u4").tobytes()))
        parts.append(pack(padded.tobytes()))
    head = json.dumps({"documents": len(ids), "tokens": len(tokens), "width": width, "zeros": zeros,
                       "parts": [len(p) for p in parts]}).encode()
    with files.written(path) as out:
        out.write(MAGIC + struct.pack("<I", len(head)) + head)
        for p in parts:
            out.write(p)


class Shard:
    """Reader of one shard: whole tokens, or access / count / occurrences."""

    def __init__(self, path: str):
        with files.opened(path) as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        size, = struct.unpack("<I", raw[8:12])
        head = json.loads(raw[12:12 + size])
        at, parts, unpack = 12 + size, [], zstandard.ZstdDecompressor().decompress
        for n in head["parts"]:
            parts.append(unpack(raw[at:at + n]))
            at += n
        self.tokens, self.width, self.zeros = head["tokens"], head["width"], head["zeros"]
        n = head["documents"]
        known = np.unpackbits(np.frombuffer(parts[1], np.uint8))[:n].astype(bool)
        self.ids = [int(i) if k else None for i, k in zip(np.frombuffer(parts[0], "<i8"), known)]
        self.lengths = np.frombuffer(parts[2], "<i8")
        self.ranks = [np.frombuffer(p, "<u4") for p in parts[3::2]]
        self.planes = [np.frombuffer(p, np.uint8) for p in parts[4::2]]

    def decode(self) -> np.ndarray:
        """All tokens: the planes' stable partitions undone from the lowest."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        after = np.zeros(self.tokens, kind)
        for level in range(self.width - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.tokens, bitorder="little").view(bool)
            z = self.zeros[level]
            before = np.empty_like(after)
            before[~bits] = after[:z]
            before[bits] = after[z:] | kind(1 << (self.width - 1 - level))
            after = before
        return after

    def _ones(self, level: int, i: int) -> int:
        block = i // BLOCK
        part = self.planes[level][block * BLOCK // 8:-(-i // 8)].copy()
        if i % 8:
            part[-1] &= (1 << i % 8) - 1
        return int(self.ranks[level][block]) + int(np.bitwise_count(part).sum())

    def access(self, i: int) -> int:
        """Token at position i."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        token = 0
        for level in range(self.width):
            bit = self.planes[level][i // 8] >> i % 8 & 1
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            token = token << 1 | int(bit)
        return token

    def _range(self, token: int, end: int) -> tuple[int, int]:
        a, b = 0, end
        for level in range(self.width):
            x, y = self._ones(level, a), self._ones(level, b)
            if token >> (self.width - 1 - level) & 1:
                a, b = self.zeros[level] + x, self.zeros[level] + y
            else:
                a, b = a - x, b - y
        return a, b

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of a token before position ``end``."""
        if token < 0 or token >> self.width:
            return 0
        a, b = self._range(token, self.tokens if end is None else min(max(end, 0), self.tokens))
        return b - a

    def occurrence(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of a token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0)[0] + k
        for level in range(self.width - 1, -1, -1):
            one = token >> (self.width - 1 - level) & 1
            want = i - self.zeros[level] if one else i
            lo, hi = 0, self.tokens - 1
            while lo < hi:          # the place whose rank passes ``want``
                mid = (lo + hi) // 2
                ones = self._ones(level, mid + 1)
                if (ones if one else mid + 1 - ones) > want:
                    hi = mid
                else:
                    lo = mid + 1
            i = lo
        return i


# --- Spark -----------------------------------------------------------------------

def _shard_batches(folder: str, tokenizer: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.get(tokenizer)
        end = np.array([END], encoder.type).tobytes()
        part, number = TaskContext.get().partitionId(), 0
        ids, held, size = [], [], 0

        def shut() -> pa.RecordBatch:
            nonlocal number, ids, held, size
            name = f"{folder}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex[:8]}.wm"
            tokens = np.frombuffer(b"".join(held), encoder.type)
            lengths = np.array([len(h) for h in held]) // encoder.type.itemsize
            write_shard(name, ids, lengths, tokens, encoder.tokenizer.get_vocab_size())
            row = [[part], [number], [name], [len(ids)], [len(tokens)]]
            number, ids, held, size = number + 1, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                ["part", "number", "path", "documents", "tokens"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                block = batch.slice(lo, 2048)
                texts = [t or "" for t in block.column(1).to_pylist()]
                for i, encoded in zip(block.column(0).to_pylist(), encoder.encode(texts)):
                    ids.append(i)
                    held.append(encoded + end)
                    size += len(encoded) // encoder.type.itemsize + 1
                    if size >= shard_tokens:
                        yield shut()
        if ids:
            yield shut()
    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shards and return their manifest:
    part, number (order of the shards), path, documents, tokens, and start
    (ids of all shards before).  Only the manifest, a row for each file,
    names the shards: files of lost task attempts are never read."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "tokens")
    files.make_folder(folder)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    shards = write_scratch(ordered.mapInArrow(
        _shard_batches(folder, tokenizer, shard_tokens),
        "part int, number int, path string, documents long, tokens long"), "manifest")
    # The manifest has a row a file of millions of tokens: sums over it are small.
    rows = sorted(shards.collect())
    start, out = 0, []
    for r in rows:
        out.append((*r, start))
        start += r.tokens
    return spark.createDataFrame(
        out, "part int, number int, path string, documents long, tokens long, start long")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shard = Shard(path)
            tokens = shard.decode().astype("<u4")
            at = np.concatenate(([0], np.cumsum(shard.lengths)))
            crc = [zlib.crc32(tokens[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.ids, pa.int64()), pa.array(at[:-1] + start), pa.array(shard.lengths),
                 pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    parts = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (manifest.select("path", "start").repartition(parts)
            .mapInArrow(_read_batches, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _token_batches(token: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path)
                at = [shard.occurrence(token, k) + start for k in range(shard.count(token))]
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], ["position"])
    return run


def find_token(manifest: DataFrame, token: int) -> DataFrame:
    """Global positions of a token, by select on the planes of every shard."""
    return manifest.select("path", "start").mapInArrow(_token_batches(token), "position long")
