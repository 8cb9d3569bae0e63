"""Literal edge cases (input -> expected) for every operator family."""

import pytest
from pyspark.sql import functions as F

from itemwise.functions import jsoncols as J
from itemwise.functions import labels as L
from itemwise.operators import clean as C
from itemwise.operators import columns as CO
from itemwise.operators import conflicts as CF
from itemwise.operators import encode as EN
from itemwise.operators import evaluate as EV
from itemwise.operators import joins as JN
from itemwise.operators import tokens as TK

ITEM = "title_x string, buy_num_x long, click_num_x long, weekly_order_cnt long"


def label_of(spark, rows, rule="a", weekly_max=7):
    df = spark.createDataFrame(rows, ITEM)
    out = C.label_items(df, rule, weekly_max=weekly_max)
    return {r.title_x: r.lable_x for r in out.collect()}


def test_rule_a_cases(spark):
    got = label_of(spark, [("pos", 2, 10, 0), ("low", 2, 11, 0), ("one", 1, 5, 0),
                           ("neg", 0, 5, 6), ("neg7", 0, 5, 7), ("negnull", 0, 5, None),
                           ("zero", 2, 0, 0)])
    assert got == {"pos": 1, "neg": 0}


def test_rule_a_without_weekly_limit(spark):
    got = label_of(spark, [("neg7", 0, 5, 7), ("negnull", 0, 5, None)], weekly_max=None)
    assert got == {"neg7": 0, "negnull": 0}


def test_rule_b(spark):
    assert label_of(spark, [("b", 2, 1, None), ("one", 1, 9, None)], rule="b") == {"b": 1}


def test_tighten(spark):
    df = spark.createDataFrame([("n", 0, None), ("p", 1, None), ("n3", 0, 3), ("u", None, 9)],
                               "title_x string, lable_x int, weekly_order_cnt long")
    assert sorted(r.title_x for r in C.tighten(df).collect()) == ["n3", "p", "u"]


def test_null_equal_join(spark):
    left = spark.createDataFrame([(None, "l")], "k string, a string")
    right = spark.createDataFrame([("x", "r1"), (None, "r2")], "k string, b string")
    rows = JN.nullsafe_left_join(left, right, on=["k"]).collect()
    assert [(r.k, r.a, r.b) for r in rows] == [(None, "l", "r2")]


def test_many_to_many(spark):
    left = spark.createDataFrame([("k", 1), ("k", 2)], "k string, a int")
    right = spark.createDataFrame([("k", 1), ("k", 2), ("k", 3)], "k string, b int")
    assert JN.merge(left, right, on=["k"]).count() == 6


def test_suffixes_and_key_columns(spark):
    left = spark.createDataFrame([("t", 1)], "title string, n int")
    right = spark.createDataFrame([("t", "t2", 5)], "item_title string, title string, n int")
    out = JN.merge(left, right, left_on=["title"], right_on=["item_title"])
    assert out.columns == ["title_x", "n_x", "item_title", "title_y", "n_y"]


def test_drop_strict_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        CO.drop_strict(df, ["a", "b"])
    assert CO.drop_tolerant(df, ["b"]).columns == ["a"]


def test_split(spark):
    df = spark.createDataFrame([("a;",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(TK.split_tokens("s")).collect()]
    assert got == [["a", ""], [""], None]


def test_topk_rules(spark):
    rows = [(1, "b;a;c;d"), (2, "a;c"), (3, "b;a"), (4, "a"), (5, None)]
    df = spark.createDataFrame([("d", i, s) for i, s in rows], "ds string, id int, s string")
    got = {r.id: r.s_topk for r in TK.topk_tokens(df, "s", 2, group=["ds"]).collect()}
    # counts: a 4, b 2, c 2, d 1
    assert got[1] == ["a", "b"]          # longer list: by frequency, ties keep list order
    assert got[2] == ["a", "c"]
    assert got[3] == ["b", "a"]          # exactly k: original order
    assert got[4] == ["a", None]         # padded
    assert got[5] == [None, None]


def test_topk_ties_keep_list_order(spark):
    df = spark.createDataFrame([("d", 1, "b;a;c;d"), ("d", 2, "a;c")], "ds string, id int, s string")
    assert {r.id: r.s_topk for r in TK.topk_tokens(df, "s", 2).collect()}[1] == ["a", "c"]


def test_topk_with_repeated_rows(spark):
    df = spark.createDataFrame([("d", "t", "a;b;c"), ("d", "t", "a;b;c"), ("d", "u", "c")],
                               "ds string, title string, s string")
    got = sorted((r.title, r.s_topk) for r in TK.topk_tokens(df, "s", 2).collect())
    assert got == [("t", ["c", "a"]), ("t", ["c", "a"]), ("u", ["c", None])]


def test_topk_with_null_group(spark):
    df = spark.createDataFrame([(None, 1, "a;b;c"), (None, 2, "c;b"), (None, 3, "c")],
                               "ds string, id int, s string")
    got = {r.id: r.s_topk for r in TK.topk_tokens(df, "s", 2).collect()}
    assert got[1] == ["c", "b"] and got[3] == ["c", None]


def test_topk_repeated_tokens_keep_their_places(spark):
    df = spark.createDataFrame([("d", "a;b;a")], "ds string, s string")
    assert TK.topk_tokens(df, "s", 2).first().s_topk == ["a", "a"]


def test_token_count_of_null_is_zero(spark):
    df = spark.createDataFrame([("a;b",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(TK.token_count("s")).collect()] == [2, 1, 0]


def test_flat_json(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{bad",), ("[]",), (None,)], "j string")
    got = [r.a for r in J.extract_flat(df, "j", ["a"]).collect()]
    assert got == ["1", None, None, None]


def test_nested_json_other_outer_key(spark):
    df = spark.createDataFrame([('{"x": {"raw_max": 3}}',), ('{"priceJson": {"raw_max": 3}}',)],
                               "j string")
    got = [r.j_raw_max for r in J.extract_nested(df, "j", "priceJson").collect()]
    assert got == [None, 3.0]


def test_ordinal_encoding(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    vocab = EN.fit_vocab(fit, ["c"])
    assert sorted((r.value, r.code) for r in vocab.collect()) == [("a", 0), ("b", 1)]
    app = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "i int, c string")
    got = {r.i: r.c for r in EN.encode(app, vocab, ["c"], vocab_of={}).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: -1.0, 4: -1.0}


def test_contradictions(spark):
    df = spark.createDataFrame([("both", 0), ("both", 1), ("one", 1), (None, 0), (None, 1)],
                               "title_x string, lable_x int")
    kept = CF.remove_conflicts(df).collect()
    assert sorted((r.title_x or "") for r in kept) == ["", "", "one"]


def test_sweep_boundary_and_empty_denominator(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.2)], "label int, score double")
    rows = {(r.threshold, r["class"]): r for r in EV.threshold_sweep(df, [0.5]).collect()}
    assert rows[(0.5, 1)].tp == 0 and rows[(0.5, 1)].precision == 0.0


def test_auc_ties_and_symmetry(spark):
    tied = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.3)], "label int, score double")
    assert EV.auc(tied).first().auc == 0.5
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), rnd.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    a = EV.auc(df).first().auc
    b = EV.auc(df.withColumn("score", 1 - F.col("score"))).first().auc
    assert abs(a + b - 1.0) < 1e-12
    # brute force over all pairs
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(a - brute) < 1e-12


def test_dedup_keeps_first_by_order_under_skew(spark):
    rows = [("hot", i, f"v{i}") for i in range(500)] + [("cold", 1, "c")]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(8)
    out = {r.k: r.v for r in C.dedup_keep_first(df, ["k"], [("n", False)]).collect()}
    assert out == {"hot": "v499", "cold": "c"}


def test_label_rules_as_columns(spark):
    df = spark.createDataFrame([(2, 10, 0)], "buy_num_x long, click_num_x long, weekly_order_cnt long")
    assert df.select(L.label_rule_a()).first()[0] == 1


def test_union_days_reports_and_raises(spark):
    from itemwise.sources.dated import union_days
    stage = spark.createDataFrame([("1", 1), ("2", 2)], "ds string, v int")
    with pytest.warns(UserWarning, match="9"):
        assert union_days(stage, ["1", "9"]).count() == 1
    with pytest.raises(ValueError):
        union_days(stage, ["7"])


def test_hash_split_is_stable_under_repartitioning(spark):
    from itemwise.operators.sample import hash_split
    df = spark.createDataFrame([(f"t{i}",) for i in range(400)], "k string")
    a = {r.k: r.split for r in hash_split(df, "k").collect()}
    b = {r.k: r.split for r in hash_split(df.repartition(7), "k").collect()}
    assert a == b and set(a.values()) == {"train", "test"}


def test_three_way_split_shares(spark):
    from itemwise.operators.sample import three_way_split
    df = spark.createDataFrame([(f"t{i}",) for i in range(4000)], "k string")
    n = {r.split: r["count"] for r in three_way_split(df, "k").groupBy("split").count().collect()}
    assert abs(n["train"] - 3200) < 150 and abs(n["valid"] - 600) < 120 and abs(n["test"] - 200) < 80


def test_null_keys_split_off_give_the_same_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20), (None, 21), ("c", 30)], "k string, w int")
    rows = [sorted((str(r.k), r.v, r.w) for r in JN.merge(left, right, on=["k"], split_nulls=x).collect())
            for x in (False, True)]
    assert rows[0] == rows[1] == [("None", 2, 20), ("None", 2, 21), ("a", 1, 10), ("b", 3, None)] or \
        sorted(map(str, rows[0])) == sorted(map(str, rows[1]))


def test_scoring_without_a_model_feature_is_an_error(spark):
    from itemwise.operators import model as MD
    rows = [(float(i % 10), float(i % 3), int(i % 10 > 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, lable_x int")
    model, history = MD.train_best(df, df, ["a", "b"], max_iter=3, patience=1, block=2, min_rows=10)
    assert history[0] == (1, 1.0) and len(history) == 2
    assert len(model.trees) == 1
    imp = {r.feature: r.splits for r in MD.feature_importance(model).collect()}
    assert imp["a"] >= 1 and imp["b"] == 0
    assert MD.score(model, df).count() == 400
    with pytest.raises(KeyError):
        MD.score(model, df.drop("b"))


def test_auc_of_every_round_matches_the_scores(spark):
    from itemwise.operators import model as MD
    import random
    rnd = random.Random(3)
    rows = [(rnd.random(), rnd.random()) for _ in range(300)]
    df = spark.createDataFrame([(a, b, int(a + 0.4 * rnd.random() > 0.7)) for a, b in rows],
                               "a double, b double, lable_x int")
    model = MD.train_gbt(df, ["a", "b"], max_iter=4, min_rows=20)
    last = MD.auc_by_round(model, df).orderBy("round").collect()[-1]
    scored = MD.score(model, df, keep=["lable_x"]).withColumnRenamed("lable_x", "label")
    assert last.round == 4 and abs(last.auc - EV.auc(scored).first().auc) < 1e-12


def test_auc_by_group(spark):
    df = spark.createDataFrame([("x", 1, 0.9), ("x", 0, 0.1), ("y", 1, 0.1), ("y", 0, 0.9)],
                               "g string, label int, score double")
    assert {r.g: r.auc for r in EV.auc_by_group(df, ["g"]).collect()} == {"x": 1.0, "y": 0.0}


def test_missing_and_empty_day_folders(spark, tmp_path):
    from itemwise import schemas as SC
    from itemwise.sources.dated import scan_dated
    root = str(tmp_path)
    spark.createDataFrame([("t", 1, 2)], SC.LABEL).write.parquet(f"{root}/d1")
    (tmp_path / "d2").mkdir()
    (tmp_path / "d2" / "notes.txt").write_text("stray")
    (tmp_path / "d1" / "notes.txt").write_text("stray")
    got = scan_dated(spark, root, "d", SC.LABEL, ["1", "2", "3"]).collect()
    assert [(r.title, r.ds) for r in got] == [("t", "1")]
    assert scan_dated(spark, root, "d", SC.LABEL, ["8"]).count() == 0
    assert scan_dated(spark, root, "d", SC.LABEL, ["8"]).columns == ["title", "buy_num", "click_num", "ds"]


def test_drop_group(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert CO.drop_group(df, {"x": ["a", "zz"], "y": ["b"]}, ["x"]).columns == ["b", "c"]


def test_step_counts_on_copies(spark):
    rows = [("t", 2, 5, 0, "c")] * 3 + [("t", 2, 9, 0, "c"), ("u", 0, 6, 1, None), ("w", 1, 9, 1, "c")]
    df = spark.createDataFrame(rows, "title_x string, buy_num_x long, click_num_x long, weekly_order_cnt long, "
                               "category_name string")
    got = {r.step: r.rows for r in C.step_counts(df, order=[("click_num_x", False)]).collect()}
    assert got == {"input": 6, "distinct": 4, "non_null_category": 3, "one_per_title": 2,
                   "not_single_buy": 1, "labelled": 1}


def test_fixed_lists():
    """The fixed values, stated again as literals."""
    from itemwise.functions.jsoncols import LLM_KEYS, STAT_FIELDS
    from itemwise.operators.sample import SAMPLE_COLUMNS, SAMPLE_PER_CLASS
    from itemwise.plans.merge import STAT_COLUMNS, STAT_DROP
    assert LLM_KEYS == ("category_first category_second brand_real brand_quality audience subj_scenario obj_scenario "
                        "time_scenario dep_scenario feature category scenario brand").split()
    assert [f for f, _ in STAT_FIELDS] == ("raw_max raw_min raw_count max_ mean_ mid_ min_ count_ group_by unit "
                                           "update_time").split()
    assert [c for c, _ in STAT_COLUMNS] == ["annual_voljson", "pricejson", "discountjson", "p_diffjson"]
    kept = {f"{c}_{f}" for c, _ in STAT_COLUMNS for f, _ in STAT_FIELDS} - set(STAT_DROP)
    assert len(STAT_DROP) == 12 and len(kept) == 32 and "pricejson_update_time" in kept
    assert EV.THRESHOLDS == [0.05, 0.1, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8,
                             0.85, 0.9, 0.95]
    assert len(SAMPLE_COLUMNS) == 18 and SAMPLE_PER_CLASS == 1000
    assert EN.SHARED_VOCAB == {"category_first": "level_one_category_name", "category_second": "category_name"}
    assert len(EN.FIT_COLUMNS) == 18 and len(EN.FILL_BEFORE_ENCODE_SCORE) == 18
