"""Corpus pipeline: documents through five stages, each one operator of
``itemwise.llm``.  Every stage is written as Parquet below the shared
checkpoint folder and read again before the next one.

1. quality rules: rejected documents go;
2. MinHash near-dedup: the first document of each class stays;
3. suffix-array dedup: bytes of repeated strings of ``PASSAGE_BYTES`` leave
   the texts (a character that is cut goes as a whole);
4. benchmark decontamination: documents that an item leaks into go;
5. SentencePiece: sampled pieces of the text, and the text decoded from them.

Columns beyond those of ``documents`` pass through unchanged, whatever their
names: while a stage runs they have names that no operator uses, and a column
that the last stage adds gets a number behind its name where that is taken
(``pieces_2``).  ``n_chars`` follows the text.  Null texts count as empty and
fail the quality rules.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemwise.llm import decontaminate, minhash, pieces, quality, suffix
from itemwise.llm.queries import table, tokenizer_file
from itemwise.session import remove_folders, scratch_path, scratch_scope

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
# Passages of over 50 words are to be cut, whose bytes vary: of the runs of 51
# words and more that documents share, 97 % have 250 bytes (66 % have 400), and
# 97 % of the documents without such a run share no string of 250 bytes.
PASSAGE_BYTES = 250

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def passing_others(stage: Stage) -> Stage:
    """The stage with all columns that are not a document's put aside."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in DOCUMENT]
        aside = {c: f"__other_{i}" for i, c in enumerate(others)}
        out = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        names = {hidden: c for c, hidden in aside.items()}
        taken = {c.lower() for c in docs.columns}
        for c in out.columns:
            if c not in names and c not in DOCUMENT:
                names[c], n = c, 2
                while names[c].lower() in taken:
                    names[c], n = f"{c}_{n}", n + 1
                taken.add(names[c].lower())
        return out.select(*[F.col(c).alias(names.get(c, c)) for c in out.columns])
    return run


@passing_others
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_rules(docs).where("kept").select(*docs.columns)


@passing_others
def keep_first_of_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(docs).where("kept").select(*docs.columns)


@passing_others
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.cut_repeats(docs, width=PASSAGE_BYTES)


@passing_others
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


@passing_others
def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    read = pieces.decode(pieces.sample_encode(docs, model, key="doc_id", alpha=1.0, seed=7), model)
    return read.select(*docs.columns, "pieces", F.size("pieces").cast("long").alias("n_pieces"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", keep_first_of_class),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("pieces", to_pieces),
]

# Sampled pieces cannot be stated in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, applied to all of ``documents``.  What a stage
    has written for itself, and its input, go when its result is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        target = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(target)
        docs = spark.read.schema(out.schema).parquet(target)
        remove_folders(spark, before)
        before = [target]
    return docs
