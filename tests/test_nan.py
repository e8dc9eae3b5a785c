"""NaN is a missing value in every operator, as null is."""

import math

import pytest
from pyspark.sql import functions as F

from sparktab.functions.scalar import clip, without_nan
from sparktab.operators import clean as C
from sparktab.operators import encoders as E
from sparktab.operators import model as M
from sparktab.operators import profile as P
from sparktab.plans.cleaning import CleaningPlan, apply_single, default_cleaning_plan

NAN = float("nan")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, 1.0, "a", 10.0), (2, NAN, "a", NAN), (3, None, "b", 30.0), (4, 3.0, "b", 50.0), (5, 3.0, None, None)],
                                 "_id long, x double, c string, target double").withColumn("fold", (F.col("_id") % 2).cast("int"))


def column(df, c, key="_id"):
    return [r[c] for r in df.orderBy(key).collect()]


def test_clip_keeps_missing_values_missing(rows):
    assert column(rows.select("_id", clip("target", 0, 40).alias("t")), "t") == [10.0, None, 30.0, 40.0, None]


def test_default_plan_gives_no_false_target_and_fills_nan(rows):
    model = default_cleaning_plan(rows).fit(rows)
    out = model.transform(rows, True)
    assert column(out, "x") == [1.0, 3.0, 3.0, 3.0, 3.0]
    assert all(v is not None and not math.isnan(v) and v <= 50 for v in column(out, "target"))


@pytest.mark.parametrize("how,want", [("mean", 7 / 3), ("median", 3.0), ("mode", 3.0), ("zero", 0)])
def test_fills_are_fitted_to_numbers_only(rows, how, want):
    assert C.fill_values(rows, {"x": how})["x"] == pytest.approx(want)
    assert column(apply_single(rows, CleaningPlan(imputation={"x": how})), "x")[1:3] == pytest.approx([want, want])


def test_mode_keeps_every_digit(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big,), (big,), (big - 1,), (-big,), (None,)], "n long")
    assert C.fill_values(df, {"n": "mode"}) == {"n": big}
    assert [r.n for r in apply_single(df, CleaningPlan(imputation={"n": "mode"})).collect()].count(big) == 3
    ties = spark.createDataFrame([(-2 ** 60 - 1,), (-2 ** 60,), (2 ** 60,)], "n long")
    assert C.modes(ties, ["n"]) == {"n": -2 ** 60 - 1}


def test_mode_of_signed_zeros_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (NAN,), (NAN,), (NAN,), (5.0,)], "x double")
    assert C.modes(df, ["x"]) == {"x": 0.0}


def test_forward_fill_does_not_carry_nan(rows):
    assert column(C.ffill_bfill(rows, ["x"], "_id"), "x") == [1.0, 1.0, 1.0, 3.0, 3.0]


def test_post_clean_checks_count_nan_targets(rows):
    got = {r.check: (r.ok, r.value) for r in C.post_clean_checks(rows, rows.drop("target")).collect()}
    assert got["target_not_null"] == (False, 2)


def test_outlier_flags_leave_nan_alone(rows):
    assert column(C.with_outlier_flags(rows, ["x"], bounds={"x": (0.0, 2.0, 0.5, 1.5)}), "x_outlier") == [False, False, False, True, True]


def test_encoders_skip_nan_targets(rows):
    plain = rows.where("target is not null and not isnan(target)")
    for enc in (lambda t: E.target_encode(t, rows, ["c"]), lambda t: E.fold_target_encode_test(t, rows.drop("fold"), ["c"], n_folds=2)):
        key = ["_id", "fold"] if "fold" in enc(rows).columns else ["_id"]
        name = [c for c in enc(rows).columns if c.endswith("_enc") or c.startswith("te_")][0]
        got, want = ([r[name] for r in enc(t).orderBy(*key).collect()] for t in (rows, plain))
        assert got == pytest.approx(want) and all(map(math.isfinite, got))
    oof = column(E.oof_target_encode(rows, ["c"]), "te_c")
    nulls = column(E.oof_target_encode(without_nan(rows), ["c"]), "te_c")
    assert oof == pytest.approx(nulls) and all(map(math.isfinite, oof))


def test_fold_maps_skip_nan_targets(rows):
    maps, prior = M.fold_te_maps(rows, ["c"], n_folds=2)
    want, _ = M.fold_te_maps(without_nan(rows), ["c"], n_folds=2)
    key = lambda m: sorted((r.value, r.model_fold, round(r.te, 9)) for r in m.collect())
    assert key(maps) == key(want) and all(math.isfinite(x[2]) for x in key(maps))
    assert rows.select(prior.alias("p")).first()["p"] == 30.0


def test_nan_categories_are_missing(spark):
    tr = spark.createDataFrame([(1, 1.5, 1.0), (2, NAN, 2.0), (3, None, 3.0)], "_id long, c double, target double")
    assert column(E.label_encode(tr, tr, ["c"]), "le_c") == [0, 1, 1]
    assert column(E.frequency_encode(tr, tr, ["c"]), "freq_c") == [1.0, 0.0, 0.0]


def test_signed_zeros_and_missing_values_are_duplicates(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 1), (NAN, 2), (None, 2), (1.0, 1)], "x double, y int")
    assert P.duplicate_rows(df).first()["n_duplicates"] == 2
    assert C.keep_first(df.withColumn("o", F.monotonically_increasing_id()), ["x", "y"], "o").count() == 3


def test_listing_has_nan_before_ingest_only(spark, smoke_dir):
    from sparktab.sources.listing import listing, raw_listing
    n = lambda df: df.select(F.count_if(F.isnan("lat"))).first()[0]
    assert n(raw_listing(spark, smoke_dir)) > 0 and n(listing(spark, smoke_dir)) == 0
