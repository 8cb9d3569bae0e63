"""The corpus pipeline against its stages' brute-force versions."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from itemwise.llm.queries import ORACLE

from . import cases
from .test_near_and_quality import brute_classes
from .test_repeats import brute_bytes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from itemwise.session import write_scratch
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(write_scratch(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stage_columns_and_order(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "suffix_dedup", "decontamination", "pieces"]
    for docs in stages[1:5]:
        assert docs.columns == stages[0].columns
    assert stages[5].columns[:5] == stages[0].columns and "pieces" in stages[5].columns


def test_each_stage_does_what_its_brute_force_does(spark, stages):
    start, good, single, cut, clean, last = stages
    # The rules stated a second time, in SQL.
    documents = duckdb.connect()
    documents.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = documents.execute(f"SELECT doc_id FROM ({ORACLE['op2_quality']}) WHERE kept").fetchall()
    assert sorted(i for i, in kept) == sorted(r.doc_id for r in good.collect())
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    first = {min(rows[i][0] for i in g) for g in brute_classes(rows)}
    assert first == {r.doc_id for r in single.collect()} and single.count() == len(first)
    rows = [(r.doc_id, r.text) for r in single.collect()]
    left = {r.doc_id: r for r in cut.collect()}
    for i, n, removed, *_ in brute_bytes(rows, P.PASSAGE_BYTES):
        assert abs(len(left[i].text.encode()) - (n - removed)) <= 4 * removed
        assert removed or left[i].text == dict(rows)[i]
        assert left[i].n_chars == len(left[i].text)
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[i:i + 13]) for w in items for i in range(len(w) - 12)}
    for r in clean.collect():
        w = r.text.lower().split()
        assert not any(tuple(w[i:i + 13]) in grams for i in range(len(w) - 12))
    gone = {r.doc_id for r in cut.collect()} - {r.doc_id for r in clean.collect()}
    assert 0 < len(gone) < cut.count() / 4
    assert last.count() == clean.count() and last.where("NOT lossless").count() == 0


def test_awkward_rows_pass_every_stage(spark):
    docs = cases.frame(spark)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF).cache()
        docs.count()
    assert docs.where("NOT lossless").count() == 0
    nothing = cases.empty(spark)
    for _, stage in P.STAGES:
        nothing = stage(spark, nothing, SF)
    assert nothing.count() == 0


def test_extra_columns_of_any_name_pass_every_stage(spark):
    from itemwise.session import write_scratch
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 4 = 0")
    names = ["pieces", "Lossless", "kept", "class_id", "n_words", "__spans", "th", "dotted.name", "members"]
    docs = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in P.STAGES:
        docs = write_scratch(stage(spark, docs, SF), f"extra-{name}")
        assert docs.columns[:5 + len(names)] == [*P.DOCUMENT, *names] or set(names) <= set(docs.columns)
        assert docs.count() > 0
        same = [F.col(f"`{n}`") == F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names]
        assert docs.where(~same[0] | ~F.array_contains(F.array(*same), False).eqNullSafe(False)).count() == 0
    assert {"pieces_2", "n_pieces", "lossless_2"} <= set(docs.columns)


def test_entry_registers_everything():
    import __spark_entry__ as E
    names = list(E.queries())
    assert "pipeline" in names and collections.Counter(n.split("_")[0] for n in names if n.startswith("op")) == {
        f"op{i}": 1 for i in range(1, 14)}
    assert set(E.oracle_sql()) <= set(names)
