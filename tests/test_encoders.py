import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sparktab.operators import encoders as E


def _frame(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "Rare" if i == 0 else "Common", float(rng.uniform(1000, 5000)), i % 5) for i in range(100)]
    rows.append((100, None, 3000.0, 0))
    return spark.createDataFrame(rows, "_id long, type_house string, target double, fold int")


def test_rare_category_shrinks_to_global_mean(spark):
    df = _frame(spark)
    out = E.target_encode(df, df, ["type_house"], smoothing=50.0).toPandas()
    gm = df.select(F.avg("target")).first()[0]
    rare_target = out.loc[out["_id"] == 0, "target"].item()
    rare_enc = out.loc[out["_id"] == 0, "type_house_target_enc"].item()
    assert abs(rare_enc - gm) < abs(rare_target - gm)
    assert out["type_house_target_enc"].notna().all()
    assert out.loc[out["_id"] == 100, "type_house_target_enc"].item() == gm


def test_oof_matches_per_fold_refit(spark):
    df = _frame(spark)
    out = E.oof_target_encode(df, ["type_house"], smoothing=10.0).toPandas().set_index("_id")
    pdf = df.toPandas()
    gm = pdf["target"].mean()
    for f in range(5):
        tr = pdf[pdf.fold != f]
        st = tr.dropna(subset=["type_house"]).groupby("type_house")["target"].agg(["sum", "count"])
        for r in pdf[pdf.fold == f].itertuples(index=False):
            if r.type_house is None or r.type_house not in st.index:
                exp = gm
            else:
                s, n = st.loc[r.type_house]
                exp = (s + 10 * gm) / (n + 10)
            assert abs(out.loc[r[0], "te_type_house"] - exp) < 1e-9


def test_frequency_sums_to_one_and_unseen_zero(spark):
    train = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "_id long, c string")
    test = spark.createDataFrame([(5, "a"), (6, "zzz"), (7, None)], "_id long, c string")
    m = E.frequency_map(train, ["c"]).toPandas()
    assert abs(m["freq"].sum() - 1.0) < 1e-12
    out = E.frequency_encode(train, test, ["c"]).toPandas().set_index("_id")
    assert out.loc[5, "freq_c"] == 2 / 3 and out.loc[6, "freq_c"] == 0 and out.loc[7, "freq_c"] == 0


def test_label_encoding_sorted_nan_and_unseen(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "_id long, c string")
    test = spark.createDataFrame([(4, "a"), (5, "new"), (6, None)], "_id long, c string")
    out = E.label_encode(train, test, ["c"]).toPandas().set_index("_id")
    # sorted train values: a, b, nan
    assert out.loc[4, "le_c"] == 0 and out.loc[5, "le_c"] == -1 and out.loc[6, "le_c"] == 2


def test_oof_frequency_leave_fold_out(spark):
    df = spark.createDataFrame([(i, "x" if i % 3 else "y", i % 2) for i in range(12)], "_id long, c string, fold int")
    out = E.oof_frequency_encode(df, ["c"]).toPandas().set_index("_id")
    pdf = df.toPandas()
    for r in pdf.itertuples(index=False):
        other = pdf[pdf.fold != r.fold]
        assert abs(out.loc[r[0], "freq_oof_c"] - (other.c == r.c).sum() / len(other)) < 1e-12




def test_fold_test_encoding_matches_fold_maps(spark):
    from sparktab.operators.model import encode_for_fold, fold_te_maps
    train = _frame(spark)
    test = spark.createDataFrame([(500, "Common"), (501, "Rare"), (502, "Unseen"), (503, None)], "_id long, type_house string")
    per_fold = {(r._id, r.fold): r.te_type_house
                for r in E.fold_target_encode_test(train, test, ["type_house"], smoothing=10.0).collect()}
    maps, gm = fold_te_maps(train, ["type_house"], smoothing=10.0)
    for f in range(5):
        for r in encode_for_fold(test, maps, ["type_house"], f, gm).collect():
            assert abs(per_fold[(r._id, f)] - r.te_type_house) < 1e-9
