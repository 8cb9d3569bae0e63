"""Pipeline-level properties on the smallest driver tables."""

from pyspark.sql import functions as F

from itemwise.functions.prefix import running_totals
from itemwise.operators import clean as C
from itemwise.plans import catalog as CT
from itemwise.plans import prepare as PR

SF = "/root/testdata/sf0.001"


def test_entry_returns_rows(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert rows and set(r.lable_x for r in rows) <= {0, 1}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_clean_is_idempotent(spark):
    first = CT.Ctx(spark, SF).first_rows()
    again = C.clean_items(first, order=PR.DEDUP_ORDER)
    assert first.exceptAll(again).count() == 0 and again.exceptAll(first).count() == 0


def test_no_title_has_two_labels_after_removal(spark):
    ctx = CT.Ctx(spark, SF)
    train = CT._train_all(ctx)
    both = (train.groupBy("title_x").agg(F.countDistinct("lable_x").alias("n"))
                 .where("n > 1").count())
    assert both == 0


def test_expanded_lists_have_fixed_width(spark):
    clean = CT.Ctx(spark, SF).clean()
    for c in ["feature1", "feature6", "scenario_1", "audience_2"]:
        assert c in clean.columns
    assert "feature" not in clean.columns and "scenario" not in clean.columns


def test_running_totals_match_cumsum(spark):
    rows = [(float(i % 17), i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, v int").groupBy("x").agg(F.sum("v").alias("v"))
    got = {r.x: r.c for r in running_totals(df, [F.col("x")], {"c": F.col("v")}, ranges=5).collect()}
    acc, want = 0, {}
    for x, v in sorted((r.x, r.v) for r in df.collect()):
        acc += v
        want[x] = acc
    assert got == want


def test_sweep_tp_non_increasing(spark):
    s = CT.QUERIES["threshold_sweep"](spark, SF).where("class = 1").orderBy("threshold").collect()
    tps = [r.tp for r in s]
    assert all(a >= b for a, b in zip(tps, tps[1:]))


def test_vocab_codes_dense(spark):
    v = CT.QUERIES["ordinal_vocab"](spark, SF)
    for col, codes in v.groupBy("column").agg(F.collect_list("code").alias("c")).collect():
        assert sorted(codes) == list(range(len(codes)))


def test_stream_matches_batch(spark):
    streamed = CT.QUERIES["streaming_daily_clean"](spark, SF)
    batch = CT.QUERIES["expand_tokens"](spark, SF)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_clean_drops_copies_and_second_matches(spark):
    ctx = CT.Ctx(spark, SF)
    nn = C.drop_null_key(ctx.raw())
    assert ctx.first_rows().count() < nn.distinct().count() < nn.count()


def test_label_distribution_parses_no_json(spark):
    plan = CT.QUERIES["label_distribution"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 1


def test_stage_reads_only_what_is_selected(spark):
    clean = CT.Ctx(spark, SF).clean().select("ds", "title_x", "lable_x").where("ds = '1996'")
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ReadSchema: struct<title_x:string,lable_x:int>" in plan
