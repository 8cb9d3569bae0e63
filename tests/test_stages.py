"""File order, measured token plans, co-partitioned stages, observed counts,
day partials, sketches, atomic days, keyed shuffle and split."""

import random
import warnings

import pytest
from pyspark.sql import functions as F

from itemwise.operators import clean as C
from itemwise.operators import conflicts as CF
from itemwise.operators import joins as JN
from itemwise.operators import profile as P
from itemwise.operators import sample as SP
from itemwise.operators import tokens as TK
from itemwise.plans import bucketed as B
from itemwise.sources import dated as DT
from itemwise.sources import manifest as MF

# --- file order ------------------------------------------------------------------


def _files(spark, tmp_path, name, rows, schema, parts):
    """Rows in their order over several files, in a folder for the day."""
    folder = tmp_path / name / "day=20240101"
    step = -(-len(rows) // parts)
    for i in range(parts):
        piece = str(tmp_path / f"{name}-{i}")
        spark.createDataFrame(rows[i * step:(i + 1) * step], schema).coalesce(1).write.parquet(piece)
        folder.mkdir(parents=True, exist_ok=True)
        for f in (tmp_path / f"{name}-{i}").glob("*.parquet"):
            (folder / f"part-{i:05d}.parquet").write_bytes(f.read_bytes())
    return str(tmp_path / name)


def test_first_rows_equal_pandas_over_joined_files(spark, tmp_path):
    import pandas as pd
    rnd = random.Random(12)
    left = [(f"t{rnd.randrange(25)}" if rnd.random() > 0.1 else None, i) for i in range(90)]
    right = [(f"t{rnd.randrange(25)}" if rnd.random() > 0.2 else None, f"r{i}") for i in range(70)]
    rnd.shuffle(left)
    rnd.shuffle(right)
    lp = _files(spark, tmp_path, "left", left, "title string, n int", 4)
    rp = _files(spark, tmp_path, "right", right, "item string, r string", 3)
    a = DT.scan_dated(spark, lp, "day=", position="__a").repartition(5)
    b = DT.scan_dated(spark, rp, "day=", position="__b").drop("ds").repartition(7)
    joined = JN.merge(a, b, left_on=["title"], right_on=["item"])
    got = C.first_in_file_order(joined, ["title"], ["__a", "__b"])
    assert got.columns == ["title", "n", "ds", "item", "r"]
    want = pd.merge(pd.DataFrame(left, columns=["title", "n"]), pd.DataFrame(right, columns=["item", "r"]), how="left",
                    left_on="title", right_on="item").drop_duplicates("title")
    clean = lambda v: None if v != v else v
    assert sorted(((r.title, r.n, r.r) for r in got.collect()), key=str) == sorted(
        ((clean(t), n, clean(r)) for t, n, r in zip(want["title"], want["n"], want["r"])), key=str)


def test_positions_of_a_missing_day(spark, tmp_path):
    from itemwise.schemas import LABEL
    found = DT.scan_dated(spark, str(tmp_path), "day=", LABEL, ["20990101"], position="__p")
    assert found.count() == 0 and found.columns == ["title", "buy_num", "click_num", "__p", "ds"]


# --- token lists -------------------------------------------------------------------

LISTS = [("d1", "a;b;c;a", "x;y;z"), ("d1", "c;b;a;e", None), ("d1", "a;b", ""), ("d2", "q;;q;r;a", "z;x;y;"), (None, "a;b;c;d", "y;x;z"),
         (None, "d;d;c;b", "one"), ("d1", "a;b;c;a", "x;y;z"), ("d2", None, None)]


def brute_topk(rows, at, k):
    freq = {}
    for r in rows:
        for t in (r[at].split(";") if r[at] is not None else []):
            freq[r[0], t] = freq.get((r[0], t), 0) + 1
    out = []
    for r in rows:
        toks = r[at].split(";") if r[at] is not None else []
        if len(toks) > k:
            toks = sorted(toks, key=lambda t: -freq[r[0], t])[:k]
        out.append(tuple(toks + [None] * (k - len(toks))))
    return out


@pytest.mark.parametrize("map_tokens", [0, TK.MAP_TOKENS])
@pytest.mark.parametrize("group", [["ds"], []])
def test_both_token_plans_equal_a_plain_ranking(spark, map_tokens, group):
    df = spark.createDataFrame(LISTS, "ds string, feature string, pair string").repartition(3)
    got = TK.topk_lists(df, [("feature", 3), ("pair", 2)], group, map_tokens=map_tokens)
    rows = LISTS if group else [("", *r[1:]) for r in LISTS]
    want = [(*r, *x) for r, x in zip(LISTS, zip(brute_topk(rows, 1, 3), brute_topk(rows, 2, 2)))]
    assert sorted(((r.ds, r.feature, r.pair, tuple(r.feature_topk), tuple(r.pair_topk)) for r in got.collect()), key=str) \
        == sorted(want, key=str)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_few_tokens_move_no_row_and_many_take_the_join(spark):
    df = spark.createDataFrame(LISTS, "ds string, feature string, pair string")
    # The only exchange is that of the counts into the maps.
    count, plan = _exchanges(TK.topk_lists(df, [("feature", 3)]))
    assert count <= 1 and "SortMergeJoin" not in plan and "Window" not in plan
    many = spark.range(60).select(F.lit("d").alias("ds"), F.concat_ws(";", *[F.col("id") * 7 + i for i in range(5)]).alias("feature"))
    assert "__map_0" in _exchanges(TK.topk_lists(many, [("feature", 3)], map_tokens=300))[1]
    assert "__map_0" not in _exchanges(TK.topk_lists(many, [("feature", 3)], map_tokens=100))[1]


# --- co-partitioned stages -----------------------------------------------------------

def test_bucketed_joins_and_first_rows_move_no_row(spark):
    def t(i):
        return None if i % 11 == 0 else f"t{i % 17}"

    label = spark.createDataFrame([(f"d{i % 2}", t(i), i % 3, i) for i in range(60)], "ds string, title string, buy_num long, click_num long")
    item = spark.createDataFrame([(f"d{i % 2}", t(i), f"shop{i}") for i in range(40)], "ds string, item_title string, shop string")
    texts = spark.createDataFrame([(t(i), f"txt{i}") for i in range(20)], "item_title string, txt string")

    def joined(a, b, c, null_equal):
        ab = JN.merge(a, b, on=["ds"], left_on=["title"], right_on=["item_title"], null_equal=null_equal).drop("item_title")
        return JN.merge(ab, c, left_on=["title"], right_on=["item_title"], null_equal=null_equal).drop("item_title")

    order = [("click_num", True), ("shop", True), ("txt", True)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with B.bucket_tables(spark) as write:
            a, b, c = write(label, "title", 4), write(item, "item_title", 4), write(texts, "item_title", 4)
            raw = joined(a, b, c, False)
            first = B.first_rows(raw.withColumn("category_name", F.lit("c")), order, title="title").drop("category_name")
            assert _exchanges(raw)[0] == 0 and _exchanges(first)[0] == 0
            rest = joined(*[df.where(F.col(k).isNull()) for df, k in ((label, "title"), (item, "item_title"), (texts, "item_title"))], True)
            got = sorted(map(str, raw.collect() + rest.collect()))
            firsts = sorted(map(str, first.collect()))
        plain = joined(label, item, texts, True)
        assert got == sorted(map(str, plain.collect()))
        want = C.dedup_keep_first(plain.where("title IS NOT NULL"), ["ds", "title"], order)
        assert firsts == sorted(map(str, want.collect()))
        assert not [x for x in spark.catalog.listTables() if x.name.startswith("itemwise_") and not x.isTemporary]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- observed counts -------------------------------------------------------------------

def test_observed_counts_equal_counted_steps(spark, tmp_path):
    rows = [("d", f"t{i % 9}", None if i % 4 == 0 else "c", i % 4, 5 + i % 3, i % 9, "{}" if i % 3 else "{bad") for i in range(50)]
    df = spark.createDataFrame(rows + rows[:7], "ds string, title_x string, category_name string, buy_num_x long, click_num_x long, "
                               "weekly_order_cnt long, j string")
    order = [("click_num_x", False), ("buy_num_x", True), ("weekly_order_cnt", True), ("j", True)]
    counts = C.CleaningCounts(distinct=True, json=["j"])
    counts.cleaned(df, order=order[:3]).write.parquet(str(tmp_path / "out"))
    want = {r.step: r.rows for r in C.step_counts(df.drop("j").distinct(), order=order[:3]).collect()}
    got = counts.rows
    assert got.pop("corrupt:j") == sum(r[6] == "{bad" for r in rows + rows[:7])
    assert got.pop("input") == 57 and want.pop("input")
    assert got == want
    short = C.CleaningCounts()
    short.cleaned(df.drop("j"), order=order[:3]).write.parquet(str(tmp_path / "short"))
    copies = sum(r[2] is not None for r in rows + rows[:7])
    assert short.rows == {"input": 57, **{k: v for k, v in want.items() if k != "distinct"}, "non_null_category": copies}


# --- growing days ------------------------------------------------------------------------

def test_day_counts_grow_and_are_replaced(spark, tmp_path):
    rnd = random.Random(2)
    days = {d: [(d, rnd.choice(["a", "b", "c", None, "e"]), rnd.randrange(2)) for _ in range(12)] for d in ("1", "2", "3")}
    frame = lambda rows: spark.createDataFrame(rows, "ds string, title_x string, lable_x int")
    stage = str(tmp_path / "counts")
    schema = CF.day_counts(frame(days["1"])).schema

    def stored():
        return MF.read_days(spark, stage, schema)

    for d in ("1", "2"):
        MF.replace_days(CF.day_counts(frame(days[d])), stage)
    days["1"] = days["1"][:3]
    MF.replace_days(CF.day_counts(frame(days["1"] + days["3"])), stage)
    everything = frame([r for d in days.values() for r in d])
    assert sorted(map(str, CF.merged_counts(stored()).collect())) == sorted(map(str, CF.label_pivot(everything).collect()))
    assert CF.pivot_report(CF.merged_counts(stored())).collect() == CF.conflict_report(everything).collect()
    assert sorted(map(str, CF.remove_counted_conflicts(everything, stored()).collect())) == sorted(
        map(str, CF.remove_conflicts(everything).collect()))


def test_sketches_of_days_merge_within_the_bound(spark):
    df = spark.range(30_000).select((F.col("id") % 3).cast("string").alias("ds"), (F.col("id") % 7).alias("few"),
                                    F.col("id").alias("all"), (F.col("id") % 9000).cast("string").alias("many"),
                                    F.lit(None).cast("string").alias("none"))
    days = P.distinct_sketches(df)
    assert days.count() == 12
    got = {r.column: r.n_estimate for r in P.sketched_nunique(days).collect()}
    for c, n in (("few", 7), ("all", 30_000), ("many", 9000), ("none", 0)):
        assert abs(got[c] - n) <= P.SKETCH_ERROR * n
    one = {r.column: r.n_estimate for r in P.sketched_nunique(P.distinct_sketches(df.drop("ds"), by=[])).collect()}
    assert one == got


# --- atomic days -----------------------------------------------------------------------------

ROW = "v int, ds string"


def _rows(df):
    return sorted((r.v, str(r.ds)) for r in df.collect())


def test_a_reader_sees_a_day_before_or_after_its_replacement(spark, tmp_path):
    stage = str(tmp_path / "stage")
    frame = lambda *rows: spark.createDataFrame(list(rows), ROW)
    schema = frame((1, "a")).schema
    assert MF.read_days(spark, stage, schema).count() == 0
    assert MF.replace_days(frame((1, "0101"), (2, "0101"), (3, "0102"), (4, None)), stage) == 1
    before = MF.read_days(spark, stage, schema)
    assert before.columns == ["v", "ds"]
    assert MF.replace_days(frame((9, "0101"), (5, "0103")), stage) == 2
    # Opened before: still the old day, whole.
    assert _rows(before) == [(1, "0101"), (2, "0101"), (3, "0102"), (4, "None")]
    assert _rows(MF.read_days(spark, stage, schema)) == [(3, "0102"), (4, "None"), (5, "0103"), (9, "0101")]
    assert _rows(MF.read_days(spark, stage, schema, version=1)) == _rows(before)
    assert _rows(MF.read_days(spark, stage, schema, days=["0103", "2050"])) == [(5, "0103")]
    assert MF.drop_days(spark, stage, ["0102"]) == 3
    MF.vacuum(spark, stage, keep=1)
    assert MF.versions(spark, stage) == [3]
    assert _rows(MF.read_days(spark, stage, schema)) == [(4, "None"), (5, "0103"), (9, "0101")]


def test_a_failed_replacement_leaves_the_day_as_it_was(spark, tmp_path):
    stage = str(tmp_path / "stage")
    good = spark.createDataFrame([(i, "1") for i in range(20)], ROW)
    MF.replace_days(good, stage)
    bad = spark.createDataFrame([(i, "1") for i in range(40)], ROW).repartition(4).select(
        F.when(F.col("v") == 37, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int").alias("v"), "ds")
    with pytest.raises(Exception, match="lost"):
        MF.replace_days(bad, stage)
    assert MF.versions(spark, stage) == [1]
    assert _rows(MF.read_days(spark, stage, good.schema)) == _rows(good)


def test_two_writers_keep_each_others_days(spark, tmp_path, monkeypatch):
    stage = str(tmp_path / "stage")
    frame = lambda *rows: spark.createDataFrame(list(rows), ROW)
    MF.replace_days(frame((1, "1")), stage)
    claim, met = MF._claim, []

    def slow(spark, stage, version, days):
        if not met:             # another writer gets in between
            met.append(version)
            MF.replace_days(frame((2, "2")), stage)
        return claim(spark, stage, version, days)

    monkeypatch.setattr(MF, "_claim", slow)
    assert MF.replace_days(frame((3, "3")), stage) == 3 and met == [2]
    assert _rows(MF.read_days(spark, stage, frame((1, "1")).schema)) == [(1, "1"), (2, "2"), (3, "3")]


# --- shuffle and split --------------------------------------------------------------------------

def test_shuffled_rows_do_not_depend_on_the_partitions(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(300)] + [(None, "n")], "k long, v string")
    orders = [[(r["index"], r.k) for r in SP.shuffled(df.repartition(n), ["k"], seed=5).orderBy("index").collect()] for n in (1, 6)]
    assert orders[0] == orders[1]
    assert [i for i, _ in orders[0]] == list(range(301))
    assert [k for _, k in orders[0]] != sorted(k or -1 for _, k in orders[0])
    other = [r.k for r in SP.shuffled(df, ["k"], seed=6).orderBy("index").collect()]
    assert other != [k for _, k in orders[0]] and len(other) == 301
    same = SP.shuffled(spark.createDataFrame([(1,)] * 50, "k long"), ["k"])
    assert sorted(r["index"] for r in same.collect()) == list(range(50))
    assert SP.shuffled(df.limit(0), ["k"]).count() == 0


def test_keyed_split_equals_its_statement(spark):
    import hashlib
    df = spark.createDataFrame([(f"k{i}",) for i in range(500)] + [(None,)], "k string")
    for r in SP.keyed_split(df, "k", (0.7, 0.3)).collect():
        text = "42|" + ("-" if r.k is None else f"{len(r.k)}:{r.k}")
        assert r.split == ("train" if int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 10_000 < 7000 else "test")


def test_absent_days_and_lists_are_warned_of(spark):
    df = spark.createDataFrame([("1", "a;b;c")], "ds string, feature string")
    with pytest.warns(UserWarning):
        assert DT.union_days(df, ["1", "2"]).count() == 1
    with pytest.raises(ValueError):
        DT.union_days(df, ["7"])
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        TK.expand_lists(df, [("nothing", 2, ["a1", "a2"])])
    assert len(seen) == 1


def test_a_scope_removes_its_folders(spark, tmp_path):
    import os

    from itemwise.plans import catalog
    from itemwise.session import checkpoint_root, scratch_scope, write_scratch
    root = f"{checkpoint_root(spark)}/itemwise".replace("file://", "").replace("file:", "")
    outside = write_scratch(spark.range(3), "outside")
    there = set(os.listdir(root))
    for name in ("auc_exact", "topk_tokens_2", "shuffle_rows_indexed"):
        with scratch_scope(spark):
            catalog.QUERIES[name](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
            assert set(os.listdir(root)) > there
        assert set(os.listdir(root)) == there
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        write_scratch(spark.range(3), "inside")
        1 / 0
    assert set(os.listdir(root)) == there and outside.count() == 3


def test_positions_within_many_groups_and_a_null_one(spark):
    from itemwise.functions.prefix import dense_positions
    rows = [(None if i % 3 == 0 else f"g{i % 40}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    got = {(r.g, r.v): r.position for r in dense_positions(df, [F.col("v")], ["g"], ranges=7).collect()}
    for g in {g for g, _ in rows}:
        assert [got[g, v] for v in sorted(v for x, v in rows if x == g)] == list(range(sum(x == g for x, _ in rows)))


def test_the_stream_writes_clean_once_and_its_batches_read_only_days(spark, tmp_path, monkeypatch):
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    from itemwise.sources import files as FI
    from itemwise.streaming import daily as DY

    rows = [("2001", "a", 1), ("2001", "b", 2), ("2002", "a", 3)]
    raw = spark.createDataFrame(rows, "ds string, title_x string, buy_num_x int")
    FI.write_stage(raw, str(tmp_path / "raw"))
    asked, columns, each = [], [], DataStreamWriter.foreachBatch

    def prepared(raw, category_feature, **kw):
        asked.append(kw.get("stage_clean", True))
        return raw

    def watched(self, fn):
        return each(self, lambda df, epoch: (columns.append(df.columns), fn(df, epoch))[1])

    monkeypatch.setattr(DY, "prepare_day_items", prepared)
    monkeypatch.setattr(DataStreamWriter, "foreachBatch", watched)
    DY.run_daily_clean(spark, str(tmp_path / "raw"), str(tmp_path / "clean"), raw.limit(0), str(tmp_path / "at"))
    assert asked == [False] and columns == [["ds"]]
    assert sorted(map(tuple, FI.read_stage(spark, str(tmp_path / "clean")).select(*raw.columns).collect())) == rows


def test_a_vocabulary_alone_writes_no_encoded_rows(spark, monkeypatch):
    from itemwise.operators import encode as EN
    from itemwise.plans import train as TR

    df = spark.createDataFrame([("b", "x", 1), ("a", None, 0)], "category_name string, feature1 string, lable_x int")
    written, write = [], TR.write_scratch
    monkeypatch.setattr(TR, "write_scratch", lambda df, name: (written.append(name), write(df, name))[1])
    tr, te, vocab = TR.fit_and_encode(df, df.limit(1), stage_encoded=False)
    assert not written
    want = [("category_name", "a", 0), ("category_name", "b", 1), ("feature1", "x", 0)]
    assert sorted(map(tuple, vocab.collect())) == want
    staged = TR.fit_and_encode(df, df.limit(1))
    assert written == ["encoded"]
    for a, b in zip((tr, te, vocab), staged):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert tr.columns == df.columns and EN.UNSEEN_CODE in {r.feature1 for r in tr.collect()}
