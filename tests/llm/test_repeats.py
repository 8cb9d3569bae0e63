"""Byte and word repeats against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemwise.llm import recompress, suffix

from . import cases


def brute_words(rows, width):
    """rows (doc_id, text) -> kept words; equal places are not earlier."""
    seen = {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        w = (t or "").encode().split()
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            place = (i is not None, i or 0, p)
            seen[k] = min(seen.get(k, place), place)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if seen[tuple(w[p:p + width])] < (i is not None, i or 0, p):
                gone[p:p + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return sorted(out, key=str)


def brute_bytes(rows, width):
    count = collections.Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, t in raw:
        count.update(t[p:p + width] for p in range(len(t) - width + 1))
    out = []
    for i, t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - width + 1):
            if count[t[p:p + width]] > 1:
                gone[p:p + width] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("rounds", [0, 2, 3])
def test_words_match_brute_force(spark, rounds):
    docs = cases.frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = recompress.substring_dedup(docs.repartition(3), rounds=rounds).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_words(rows, 20)


def test_words_with_runs_and_short_periods(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(25):
        parts = [rnd.choice(["a ", "b ", "a b ", "a a b "]) * rnd.randrange(1, 25) for _ in range(4)]
        rows.append((i, "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = recompress.substring_dedup(docs, rounds=2).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_words(rows, 20)


@pytest.mark.parametrize("crowd,huge", [(512, 50_000), (0, 50_000), (0, 0)])
def test_bytes_match_brute_force(spark, crowd, huge):
    docs = cases.frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffix.suffix_dedup(docs.repartition(3), crowd=crowd, huge=huge)
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_bytes(rows, 400)


def test_cut_texts_keep_columns_and_whole_characters(spark):
    shared = "ü" * 300
    docs = cases.frame(spark, ["a" + shared, "bcd" + shared + "é", "clean", None], start=1)
    rows = {r.doc_id: r for r in suffix.cut_repeats(docs).collect()}
    # The first byte of é also follows 399 bytes of the shared run inside the run.
    assert [rows[i].text for i in (1, 2, 3, 4)] == ["a", "bcd", "clean", ""]
    assert rows[2].n_chars == 3 and rows[1].spans == "s" and rows[1].th == "t"
    assert suffix.cut_repeats(docs).columns == docs.columns


def test_empty_tables(spark):
    assert recompress.substring_dedup(cases.empty(spark)).count() == 0
    assert suffix.suffix_dedup(cases.empty(spark)).count() == 0
    assert suffix.cut_repeats(cases.empty(spark)).count() == 0


def test_equal_windows_share_determined_symbols():
    """A window's determined symbols do not depend on what is around it."""
    rnd = random.Random(4)
    for _ in range(60):
        window = np.array([rnd.randrange(1, 4) for _ in range(20)], np.uint64)
        found = []
        for _ in range(2):
            before, after = ([rnd.randrange(1, 4) for _ in range(rnd.randrange(0, 12))] for _ in range(2))
            text = np.concatenate((np.array(before, np.uint64), window, np.array(after, np.uint64)))
            at = len(before)
            inside = []
            for level, (name, lo, hi) in enumerate(recompress.grammar(text, np.array([0, len(text)]), 2)):
                assert (np.diff(lo) >= 0).all() and (np.diff(hi) >= 0).all()
                use = (lo >= at) & (hi <= at + 20)
                inside.append((level, [(int(n), int(a - at), int(b - at)) for n, a, b in
                                       zip(name[use], lo[use], hi[use])]))
            found.append(inside)
        assert found[0] == found[1]


def test_groups_are_maximal_with_all_occurrences():
    rnd = random.Random(3)
    for trial in range(80):
        base = "".join(rnd.choice("ab" if trial % 2 else "abcd") for _ in range(30))
        made = set()
        for _ in range(rnd.randrange(2, 6)):
            t = list(base[rnd.randrange(9):rnd.randrange(18, 30)])
            for _ in range(rnd.randrange(3)):
                t[rnd.randrange(len(t))] = rnd.choice("abcd")
            made.add("".join(t).encode())
        made = sorted(made)
        group, length, which, start = suffix.repeat_groups(made, np.array([len(t) - 5 for t in made]), 6)
        by = collections.defaultdict(list)
        for g, n, i, s in zip(group, length, which, start):
            by[g].append((n, i, s))
        for places in by.values():
            word = made[places[0][1]][places[0][2]:places[0][2] + places[0][0]]
            every = [(i, p) for i, t in enumerate(made) for p in range(len(t)) if t.startswith(word, p)]
            assert sorted((i, s) for _, i, s in places) == every and len(every) > 1
            assert len({made[i][s - 1:s] if s else i for i, s in every}) > 1
            assert len({made[i][s + len(word):s + len(word) + 1] or -1 - i for i, s in every}) > 1
