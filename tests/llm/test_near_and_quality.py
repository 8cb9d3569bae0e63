"""Near duplicates and quality rules."""

import collections
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from itemwise.llm import minhash, quality
from itemwise.llm.graph import components
from itemwise.llm.queries import ORACLE

from . import cases


def shingles(text):
    w = (text or "").split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def brute_classes(rows, least=0.8):
    """Row numbers of every class."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = sum((sets[i] & sets[j]).values())
            if common and common >= least * (sum(sets[i].values()) + sum(sets[j].values()) - common):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return groups.values()


def test_classes_match_brute_force(spark):
    rnd = random.Random(7)
    made = cases.texts()
    base = made[0].split()
    for _ in range(40):   # a large group of near copies
        copy = list(base)
        copy[rnd.randrange(len(copy))] = f"z{rnd.randrange(1000)}"
        made.append(" ".join(copy))
    docs = cases.frame(spark, made)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = minhash.near_duplicates(docs.repartition(3))
    assert set(docs.columns) <= set(got.columns) and got.columns.count("class_id") == 1
    got = got.collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for group in brute_classes(rows):
        ids = [rows[i][0] for i in group]
        want.update((i, min((x for x in ids if x is not None), default=None), len(ids)) for i in ids)
    assert collections.Counter((r.doc_id, r.class_id, r.members) for r in got) == want
    kept = collections.Counter((r.class_id, r.text if r.members == 1 else None) for r in got if r.kept)
    assert max(kept.values()) == 1 and sum(kept.values()) == len(brute_classes(rows))


def test_crowd_hides_no_pairs(spark, monkeypatch):
    """A crowd at about 0.75 by a shared passage holds pairs above 0.8 whose
    ends are both below 0.8 to the leaders of the crowd's buckets."""
    rnd = random.Random(11)
    passage, made = cases.words(rnd, 172, 10**6), []
    for _ in range(70):
        shared = cases.words(rnd, 9, 10**6)
        made += [f"{passage} {shared} {cases.words(rnd, 19, 10**6)}" for _ in range(2)]
    rows = list(enumerate(made))
    want = {tuple(sorted(g)) for g in brute_classes(rows)}
    assert len(want) == 70
    for tile in (minhash.TILE, 16):
        monkeypatch.setattr(minhash, "TILE", tile)
        got = collections.defaultdict(list)
        for r in minhash.near_duplicates(cases.frame(spark, made[:], start=1)).collect():
            got[r.class_id].append(r.doc_id - 1)
        assert {tuple(sorted(g)) for g in got.values()} == want


def test_no_documents_and_no_pairs(spark):
    assert minhash.near_duplicates(cases.empty(spark)).count() == 0
    lone = cases.frame(spark, ["a b c d e f", None, ""], start=5)
    assert [r.kept for r in minhash.near_duplicates(lone).collect()] == [True] * 3


def test_darts_estimate_weighted_similarity():
    import numpy as np
    rnd = random.Random(1)
    hits = total = 0
    for k in range(60):
        a = [f"{k}a{i}" for i in range(200)]
        b = a[:180] + [f"{k}b{i}" for i in range(20)]
        texts = [" ".join(t).encode() for t in (a, b)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        gram, off = minhash.units(data, np.array([0, len(texts[0]), len(data)]), size=1)
        sig = minhash.signatures(gram, off)
        hits += int((sig[0] == sig[1]).sum())
        total += sig.shape[1]
    assert abs(hits / total - 180 / 220) < 0.02


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def quality_rows(spark):
    rnd = random.Random(5)
    rows = cases.texts() + ["one two three four five six seven eight " * 6, "a\nb\na\na\n\n \n" * 12,
                            "word | word " * 40, "LOUD WORDS EVERY LINE HERE OK " * 20]
    rows += [" ".join(f"t{rnd.randrange(10**6)}" for _ in range(40)) for _ in range(150)]
    return cases.frame(spark, rows)


def test_quality_matches_sql(spark):
    docs = quality_rows(spark)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").where("doc_id IS NOT NULL")
                 .dropDuplicates(["doc_id"]).toPandas())
    want = sorted(con.execute(ORACLE["op2_quality"]).fetchall())
    got = quality.quality_rules(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    got = got.select("doc_id", *quality.BASE, "kept").collect()
    assert sorted(tuple(r) for r in got) == want


def test_quality_edges(spark):
    docs = quality_rows(spark)
    out = quality.quality_rules(docs)
    assert out.count() == docs.count() and out.columns.count("kept") == 1
    by = {r.doc_id: r for r in out.collect()}
    assert by[6].n_words == 0 and by[6].base_failed and not by[6].kept
    n = len(cases.texts())
    assert by[n].n_repeat_words == 48 and by[n].base_failed          # 8 words, six times
    assert by[n + 1].n_dup_lines == 46 and not by[n + 2].kept and not by[n + 3].kept
    assert all(by[i].kept for i in range(n + 4, n + 154))
    assert quality.quality_rules(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("value", [0, 1, 63, 64, 65, 127, 128, 1000, 123456])
def test_sketch_buckets_hold_their_values(spark, value):
    row = spark.range(1).select(quality.bucket(F.lit(value)).alias("b"))
    top = row.select(quality.bucket_top(F.col("b")).alias("t")).first().t
    assert value <= top <= value + max(value // 32, 0)


def test_sketches_merge_by_adding(spark):
    rows = quality.measured(quality_rows(spark))
    whole = {(r.metric, r.b): r.c for r in quality.merged(quality.sketches(rows), []).collect()}
    a, b = rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1 OR doc_id IS NULL")
    both = collections.Counter()
    for part in (a, b):
        both.update({(r.metric, r.b): r.c for r in quality.merged(quality.sketches(part), []).collect()})
    assert whole == dict(both)
