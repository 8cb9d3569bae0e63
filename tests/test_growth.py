"""Steps whose work must not grow faster than the tables."""

import pytest
from pyspark.sql import functions as F

from itemwise.operators import boost
from itemwise.plans import catalog as CT
from itemwise.plans import catalog_stages as CS
from itemwise.plans import standins as S
from test_boost import COLUMNS, rows_of


def _tables(spark, folder, n=60):
    """lineitem and part with copied rows, null keys and several matches."""
    lines = [(i % 13 or None, i % 4 or None, f"{1995 + i % 3}-0{1 + i % 9}-01", "ARN"[i % 3], "OF"[i % 2], float(i % 7),
              float(i % 11), (i % 5) / 100, (i % 4) / 100) for i in range(n)]
    (spark.createDataFrame(lines, "l_partkey long, l_suppkey long, d string, l_returnflag string, l_linestatus string, "
                                  "l_quantity double, l_extendedprice double, l_discount double, l_tax double")
     .withColumn("l_shipdate", F.to_date("d")).drop("d").write.parquet(f"{folder}/lineitem.parquet"))
    parts = [(i % 12 or None, f"red item{i}", f"Brand#{i % 3}", f"T{i % 2}", 40 + i, 900.0 + i) for i in range(14)]
    (spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                                  "p_retailprice double").write.parquet(f"{folder}/part.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["dua_src", "ici_src"])
def test_repeated_standins_are_aggregated_once(spark, tmp_path, name):
    d = _tables(spark, tmp_path)
    found = S.standin(spark, d, name)
    stated = spark.sql(S.sql_for(name, "`"))
    assert found.schema == stated.schema or [f.dataType for f in found.schema] == [f.dataType for f in stated.schema]
    assert found.columns == stated.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, stated.collect()))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_clean_read_once_expands_only_what_is_asked_for(spark):
    d = "/root/testdata/sf0.001"
    found = CT.QUERIES["select_ordered"](spark, d)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__map_0" in plan and "__map_3" not in plan      # feature, but not audience


def test_files_in_order_follow_the_partitions(spark, tmp_path):
    d = _tables(spark, tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = CS._as_files(CT.Ctx(spark, d), "ici_src", CS.SC.ICI, "at")
        keys = [r["h"] for r in df.withColumn("h", CS.SP._keyed("file", CS.FILE_KEYS["ici_src"])).orderBy("at").collect()]
        assert keys == sorted(keys) and len(df.inputFiles()) > 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_boosting_uses_idle_cores_and_gives_the_same_trees(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(n=400), COLUMNS).withColumn("__t", F.rand(1))
    train, valid = df.where("__t < 0.7"), df.where("__t >= 0.7")
    p = boost.Params(min_rows=10, num_leaves=4, step_size=0.3)

    def fitted():
        model, history = boost.fit(train, valid, ["a", "b", "c"], rounds=2, patience=50, block=2, params=p)
        return [(t.feature.tolist(), t.threshold.tolist(), t.value.tolist(), t.rows.tolist()) for t in model.trees], history

    alone = fitted()
    seen, made = [], boost._Rows.__init__

    def init(self, *a):
        made(self, *a)
        seen.append(self.parts)

    monkeypatch.setattr(boost, "LEAST_ROWS", 50)
    monkeypatch.setattr(boost._Rows, "__init__", init)
    assert fitted() == alone
    assert max(seen) > 1 and alone[0]


def test_lists_with_frequent_tokens_leave_the_join(spark, monkeypatch):
    """Lists that hold k of the most frequent tokens have their top there; ties
    at the end of the head, null groups and lists without frequent tokens
    come out as by the join alone."""
    import random

    from itemwise.operators import tokens as TK

    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(draw.choice(["a", "b", None]), " ".join(draw.choices(words, [1 / (i // 3 + 1) for i in range(60)], k=draw.randint(0, 12))))
            for _ in range(300)] + [("a", None), ("b", ""), ("c", "x y z x y"), (None, "w59 w58 w57 w56 w59")]
    df = spark.createDataFrame(rows, "g string, text string")
    joined = []
    by_join = TK._by_join

    def seen(df, lists, *rest):
        joined.append(lists.where(F.size("__a") > F.col("__k")).count())
        return by_join(df, lists, *rest)

    monkeypatch.setattr(TK, "_by_join", seen)
    found = [sorted(map(repr, TK.topk_lists(df, [("text", 3)], ["g"], " ", map_tokens=0, head_tokens=n).collect()))
             for n in (0, 1, 7, 8, 32)]
    assert all(f == found[0] for f in found) and len(found[0]) == len(rows)
    assert joined[-1] < joined[2] < joined[0] and joined[-1] < joined[0] / 2


def test_a_stage_read_for_token_lists_holds_no_other_columns(spark, tmp_path, monkeypatch):
    """columns that the query does not read stay out of the joins and the stage."""
    held, staged = [], CS.PR.staged

    def seen(df, *rest):
        held.append(set(df.columns))
        return staged(df, *rest)

    monkeypatch.setattr(CS.PR, "staged", seen)
    found = CT.QUERIES["expand_tokens_by_join"](spark, _tables(spark, tmp_path))
    assert held == [{"ds", "title_x", "lable_x", "feature", *CS.TK.PAIR_COLUMNS}]
    whole = CT.QUERIES["expand_tokens"](spark, str(tmp_path)).select(*found.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_counted_cleaning_shuffles_no_joined_rows_again(spark, tmp_path):
    """F8: rows joined by title lie together already; a title with most rows is
    still split among tasks, and the counts are those of the plain steps."""
    from itemwise.operators import clean as C
    from itemwise.operators.joins import merge
    from itemwise.session import skewed_joins_split

    titles = ["hot"] * 20000 + [None, ""] * 20 + [f"t{i % 90}" for i in range(400)]
    left = spark.createDataFrame([(str(i % 3), t, i % 4, 9 + i % 5, None if i % 11 == 0 else "c",
                                   i // 400 * 7919 % 1009) for i, t in enumerate(titles)],
                                 "ds string, title_x string, buy_num_x long, click_num_x long, category_name string, "
                                 "weekly_order_cnt long")
    right = spark.createDataFrame([(t, i) for i, t in enumerate([None, "", "hot", "t1", "t1", "t2"])], "title string, extra int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in conf}
    order = [("click_num_x", False), ("buy_num_x", True), ("weekly_order_cnt", True), ("extra", True)]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        raw = merge(left.repartition(8), right, left_on=["title_x"], right_on=["title"], how="left").drop("title")
        planned = C.CleaningCounts(distinct=True).cleaned(raw, order=order)._jdf.queryExecution().executedPlan().toString()
        assert planned.split("SortMergeJoin")[0].count("Exchange") == 0
        counts = C.CleaningCounts(distinct=True)
        with skewed_joins_split(spark):
            cleaned = counts.cleaned(raw, order=order)
            found = cleaned.collect()
        assert "skew=true" in cleaned._jdf.queryExecution().executedPlan().toString()
        assert {r.step: r.rows for r in C.step_counts(raw, order=order).collect()} == counts.rows
        plain = C.label_items(C.clean_items(raw, order=order))
        assert cleaned.columns == plain.columns and sorted(map(repr, found)) == sorted(map(repr, plain.collect()))
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
