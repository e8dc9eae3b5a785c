"""Cases that a fixture without nulls, ties, big numbers or unordered files cannot show."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from sparktab.functions import jsonx
from sparktab.operators import clean, evaluate, guards, model, ordering, profile, retrieval
from sparktab.plans.cleaning import CleaningPlan, apply_single
from sparktab.plans.features import FeaturePlan


def test_stream_pairs_on_unordered_files(spark, tmp_path):
    from sparktab.operators.events import pair_start_end
    from sparktab.sources.eventlog import event_log
    from sparktab.streaming.jobs import stream_phase_pairs
    src = str(tmp_path / "events.parquet")
    spark.read.parquet("/root/testdata/sf0.01/events.parquet").repartition(8, F.rand(3)).write.parquet(src)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = stream_phase_pairs(spark, src).where("status <> 'timeout'").select("phase", "seq", "duration_s").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = pair_start_end(event_log(spark, "/root/testdata/sf0.01")).select("phase", "seq", "duration_s").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_the_unrounded_score_ranks(spark):
    docs = spark.createDataFrame([(1, [1.0, 1e-4]), (2, [1.0, 0.0])], "id long, v array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "qid long, v array<double>")
    assert [r.doc_id for r in retrieval.topk_inner_product(docs, "id", "v", q, "qid", "v", k=1).collect()] == [2]


@pytest.mark.parametrize("kind", ["int", "timestamp", "skewed", "string", "nulls"])
def test_blocked_and_plain_running_values_agree(spark, kind):
    def key(i):
        return {"int": i, "timestamp": dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), "string": f"k{i:04d}",
                "skewed": i if i < 299 else 10 ** 12, "nulls": None if i == 0 else i}[kind]
    t = {"timestamp": "timestamp_ntz", "string": "string"}.get(kind, "long")
    df = spark.createDataFrame([(i % 3, key(i), None if i % 4 else float(i)) for i in range(300)], f"g int, k {t}, v double")
    for reverse in (False, True):
        a, b = ({(r.g, r.k): r.l for r in ordering.running_last(df, {"l": F.col("v")}, "k", ["g"], True, reverse, n).collect()} for n in (None, 4))
        assert a == b
    sizes = [r["count"] for r in ordering._with_key_blocks(df, "k", 4).groupBy("_blk").count().collect()]
    assert max(sizes) <= 2 * 300 / 4
    if kind == "int":
        c, d = ({r.k: r.cum for r in ordering.prefix_sum(df.na.fill(0.0), "k", "v", n_blocks=n).collect()} for n in (None, 4))
        assert c == d


def test_integer_casts_keep_every_digit(spark):
    df = spark.createDataFrame([("9007199254740993", 9007199254740993), ("1e30", 1), ("x", None), (" 12 ", 2)], "s string, b long")
    out = df.select(clean.cast_expr(df, "s", "int").alias("s"), clean.cast_expr(df, "b", "int").alias("b")).collect()
    assert [r.s for r in out] == [9007199254740993, None, None, 12] and out[0].b == 9007199254740993


def test_fractional_fill_of_whole_numbers(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x long")
    out = df.select(clean.fill_expr(df, "x", clean.fill_values(df, {"x": "median"})["x"]).alias("x"))
    assert sorted(r.x for r in out.collect()) == [1, 2, 2.5, 3, 4]


def test_duplicates_differ_by_a_microsecond_and_ties_leave_one(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    df = spark.createDataFrame([(t, 1), (t.replace(microsecond=2), 1)], "t timestamp_ntz, o int")
    assert profile.duplicate_rows(df, ["t"]).first()["n_duplicates"] == 0
    tied = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, o int, v string")
    rows = clean.keep_first(tied, ["k"], "o").collect()
    assert sorted(r.k for r in rows) == ["a", "b"] and len(rows[0]) == 3


def test_feature_guard_counts_nan_and_infinity(spark):
    df = spark.createDataFrame([(math.nan, 1.0, 5.0), (math.nan, math.inf, 5.0)], "a double, b double, c double")
    got = {r.check: r.value for r in guards.validate_features(df, exclude=()).collect()}
    assert got["mostly_missing_columns"] == 1 and got["constant_columns"] == 2 and got["infinite_values"] == 1


def test_cleaning_plan_reads_both_forms_and_refuses_unknown_steps(spark):
    df = spark.createDataFrame([(1, "a", "7"), (2, "b", None)], "_id int, gone string, n string")
    plan = CleaningPlan.from_dict({"drop_cols": ["gone"], "rename_cols": {"n": "m"}, "cast": {"m": "int"}, "impute": {"n": "unknown"}})
    out = apply_single(df, plan)
    assert out.columns == ["_id", "m"]
    with pytest.raises(ValueError):
        CleaningPlan.from_dict({"drop_columns": [], "explode": 1})
    with pytest.raises(ValueError):
        CleaningPlan.from_dict({"drop_columns": [], "drop_cols": []})


def test_linear_importance_of_encoded_features(spark):
    rows = [(i, "abc"[i % 3], float(i % 7), 100.0 * (i % 3) + 0.01 * (i % 7), i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "_id int, cat string, x double, target double, fold int")
    r = model.cross_validate(df, None, "linear", {}, ["x"], ["cat"], parallelism=1)
    imp = {x.feature: x.importance for x in r.importances.groupBy("feature").agg(F.avg("importance").alias("importance")).collect()}
    assert imp["te_cat"] > imp["x"] > 0


def test_feature_plan_parameters_take_effect(spark):
    rows = [(i, float(i), float(i * i), 1.0 + i % 4, 2.0) for i in range(20)]
    df = spark.createDataFrame(rows, "_id int, a double, b double, c double, target double")
    off = {g: {"enabled": False} for g in FeaturePlan().groups}
    plan = FeaturePlan(groups={**off, "ratio_features": {"enabled": True, "pairs": [["b", "a"]]}, "target_encoding": {"enabled": False, "smoothing": 3}})
    tr, te, num, _ = plan.transform_pair(df, df.drop("target"))
    assert num == ["a", "b", "c", "ratio_b_a"] and plan.smoothing == 3
    plan.max_features = 2
    tr, te, num, _ = plan.transform_pair(df, df.drop("target"))
    assert num == ["a", "b"] and set(te.columns) == {"_id", "a", "b"} and "target" in tr.columns


def test_many_models_compare(spark):
    rows = [(m, f, float(m * f % 11 + f)) for m in range(70) for f in range(3)]
    fm = spark.createDataFrame([(f"m{m:02d}", f, x) for m, f, x in rows], "algo string, fold int, mse double")
    assert len(evaluate.models_of(fm)) == 70


@pytest.mark.parametrize("text,want", [
    ('x ```json\n{"a": 1}\n``` {"b": 2}', (True, {"a": 1})), ('{"a": "}{", "b": [1, {"c": "]"}]} tail', (True, {"a": "}{", "b": [1, {"c": "]"}]})),
    ("[1, 2] and {\"k\": 1}", (True, {"k": 1})), ("say [1, 2", (False, None)), ("", (False, None)), (None, (False, None)),
    ("null", (True, None)), ("```\nnot json\n``` then [3]", (True, [3]))])
def test_json_candidates(text, want):
    assert jsonx.parse_candidates(text) == want


def test_stream_guard_sees_every_event(spark, tmp_path):
    from sparktab.streaming.jobs import stream_guard
    src = str(tmp_path / "events.parquet")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.unionAll(e.limit(5)).repartition(2).write.parquet(src)
    rows = stream_guard(spark, src).where("check = 'rows'").collect()
    assert sum(r.value for r in rows) == e.count() and os.path.isdir(src)


def test_stream_guard_keeps_late_events(spark, tmp_path):
    from sparktab.streaming.jobs import stream_guard
    src = str(tmp_path / "events.parquet")
    e = spark.range(600).selectExpr("id AS event_id", "timestampadd(MINUTE, cast(pmod(id * 7919, 600) * 72 AS int), timestamp_ntz'2024-01-01 00:00:00') AS ts",
                                    "id % 5 AS user_id", "'click' AS event_type", "if(id % 10 = 0, -1.0D, 1.0D) AS value", "'{}' AS props")
    shuffled = e.repartition(6, "event_id")
    shuffled.write.parquet(src)
    shuffled.limit(50).coalesce(1).write.mode("append").parquet(src)
    got = stream_guard(spark, src).groupBy("check").agg({"value": "sum"}).collect()
    assert {r["check"]: r["sum(value)"] for r in got} == {"rows": 600, "null_values": 0, "negative_values": 60}
