"""Token counts with a digest cache (operator 13).

A text is known by the SHA-256 of its normalised content, a tokenizer by the
SHA-256 of its file and its library's version.  The cache is a Parquet table
(version, digest, n_tokens) that runs append to and never rewrite.  A run
digests its texts, joins the distinct digests to the stored counts of its
tokenizer, encodes one text for each digest that is missing, appends those
counts, and joins all counts back to the rows.

Normalising must not change a count.  For a tokenizer that itself turns white
space into one space, drops it between words and lower-cases, runs of ASCII
white space become one space, those at the ends go, and A-Z are lower-cased -
unless the lower-cased text spells an added token, which is found before any
normalising, or a mark follows a capital, with which only one of the two cases
may compose.  For any other tokenizer the text is taken as it is.

A text is split at ASCII white space where the tokenizer drops it anyway, and
the library is asked once for each distinct word of a task's memory: a text's
count is the sum of its words'.  Other tokenizers get whole texts.

Texts move at most once, by digest, after each task has combined its own
copies; the rows themselves only as (key, bytes, digest).  Digests of many
copies (a thousandth of the rows or more, so at most a thousand digests) are
broadcast instead of shuffled.

Input handling: null text is empty; empty texts have 0 tokens; every row gives
a row, whatever repeats; a null key stays null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemwise.session import scratch_path, small_batches, write_scratch

LIMIT = 2048
SLICE_BYTES = 1 << 20        # bytes of text given to the library at a time
CACHE_WORDS = 500_000        # distinct words whose counts a worker keeps (some 120 bytes each)
FEW_DIGESTS = 200_000        # missing digests (32 bytes each) that may be broadcast
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STORED = "version string, digest binary, n_tokens long"


def library_of(path: str) -> str:
    return "sentencepiece" if path.endswith(".model") else "tokenizers"


def version_of(path: str) -> str:
    """Digest of the tokenizer's file and its library's version."""
    with open(path, "rb") as f:
        found = hashlib.sha256(f.read())
    library = library_of(path)
    found.update(f"{library} {importlib.metadata.version(library)}".encode())
    return found.hexdigest()


def _described(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _folds_case_and_space(made: dict) -> bool:
    steps = (made.get("normalizer") or {}).get("normalizers", [])
    kinds = [s["type"] for s in steps]
    space = [s for s in steps if s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " "]
    splits = [s for s in (made.get("pre_tokenizer") or {}).get("pretokenizers", []) if s["type"] == "Split"]
    drops = any(s["behavior"] == "Removed" and s["invert"] and r"[^\s" in s["pattern"].get("Regex", "") for s in splits)
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1
                    for t in made["added_tokens"])
    return kinds == ["NFC", "Replace", "Lowercase"] and bool(space) and drops and plain


def normal_form(text: Column, path: str) -> Column:
    """Content whose equality implies equal counts."""
    if library_of(path) != "tokenizers":
        return text
    made = _described(path)
    if not _folds_case_and_space(made):
        return text
    even = F.btrim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))
    small = F.translate(even, CAPITALS, SMALL)
    kept = F.rlike(even, F.lit(r"[A-Z]\p{M}"))
    for token in made["added_tokens"]:
        kept = kept | F.contains(small, F.lit(token["content"].lower()))
    return F.when(kept, even).otherwise(small)


class _Counter:
    """Numbers of tokens, without any that the library adds by itself."""

    _made: dict[str, _Counter] = {}

    def __init__(self, path: str):
        self.words: dict[bytes, int] | None = None
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task has one core
        if library_of(path) == "tokenizers":
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.whole = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            if _folds_case_and_space(_described(path)):
                self.words = {}
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]

    def count(self, texts: list[bytes]) -> list[int]:
        if self.words is None:
            return self.whole([t.decode() for t in texts])
        split = [t.split() for t in texts]        # at ASCII white space
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        new = list(set().union(*split) - self.words.keys())
        self.words.update(zip(new, self.whole([w.decode() for w in new]) if new else []))
        return [sum(map(self.words.__getitem__, words)) for words in split]

    @classmethod
    def get(cls, path: str) -> _Counter:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]


def _slices(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter.get(path)
        for batch in batches:
            counts: list[int] = []
            for texts in _slices(t.as_py() for t in batch["text"].cast(pa.binary())):
                counts += counter.count(texts)
            yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


# --- the cache -------------------------------------------------------------------

def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """(digest, n_tokens) that the cache holds for a tokenizer; runs that
    appended at the same time may both have stored a digest, with equal counts."""
    if not _exists(spark, cache):
        return None
    rows = spark.read.schema(STORED).parquet(cache).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _texts(docs: DataFrame, missing: DataFrame, n_missing: int, everything: bool) -> DataFrame:
    """One (digest, text) for each missing digest."""
    def one_each(rows):
        return rows.groupBy("digest").agg(F.first("text").alias("text"))

    if everything:
        return one_each(docs)
    if n_missing <= FEW_DIGESTS:
        return one_each(docs.join(F.broadcast(missing), "digest", "left_semi"))
    return one_each(docs).join(missing, "digest", "left_semi")


def _with_counts(rows: DataFrame, distinct: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """Joins the counts to the rows, those of frequent digests by broadcast."""
    often = distinct.where(F.col("copies") >= max(1000, -(-total // 1000))).select("digest")
    hot = counts.join(F.broadcast(often), "digest", "left_semi")       # at most 1000 rows
    marked = rows.join(F.broadcast(hot), "digest", "left")
    rest = marked.where("n_tokens IS NULL").drop("n_tokens").join(counts, "digest")
    return marked.where("n_tokens IS NOT NULL").unionByName(rest)


def token_counts(docs: DataFrame, path: str, cache: str | None = None, key: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row, by the tokenizer at
    ``path``, a file that every machine has there.  ``cache`` is the folder of
    the stored counts; without one the run starts its own."""
    spark = docs.sparkSession
    small_batches(spark)
    cache = cache or scratch_path(spark, "token-cache")
    version = version_of(path)
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias(key), whole.alias("text"),
                        F.unhex(F.sha2(normal_form(whole, path), 256)).alias("digest"))
    rows = write_scratch(texts.select(key, F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "digests")
    distinct = write_scratch(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")), "distinct-digests")

    known = stored_counts(spark, cache, version)
    missing = distinct.select("digest")
    if known is not None:
        missing = write_scratch(missing.join(known, "digest", "left_anti"), "missing-digests")
    n_missing = missing.count()
    if n_missing:
        new = _texts(texts.select("digest", "text"), missing, n_missing, known is None)
        (new.mapInArrow(_encode(path), "digest binary, n_tokens long")
         .select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache))
        known = stored_counts(spark, cache, version)
    if known is None:
        known = spark.createDataFrame([], "digest binary, n_tokens long")
    total = rows.count()
    return _with_counts(rows, distinct, known, total).select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
