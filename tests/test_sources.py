import os
import tempfile

from pyspark.sql import functions as F

from sparktab.sources import files as IO


def test_load_csv_latin1_fallback(spark):
    d = tempfile.mkdtemp(prefix="sparktab-test-")
    p = os.path.join(d, "train.csv")
    with open(p, "wb") as f:
        f.write("_id,name\n1,Caf\xe9 cr\xe8me\n2,plain\n".encode("latin-1"))
    df = IO.load_csv(spark, p, "_id long, name string")
    assert {r.name for r in df.collect()} == {"Café crème", "plain"}


def test_load_text_dir_rules(spark):
    d = tempfile.mkdtemp(prefix="sparktab-kb-")
    os.makedirs(os.path.join(d, "sub"))
    files = {"a.txt": "  alpha  \n", "sub/b.MD": "beta", "c.csv": "x,y", "empty.txt": "   \n"}
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    kb = IO.load_text_dir(spark, d).orderBy("doc_id").collect()
    assert [r.text for r in kb] == ["alpha", "beta"] and [r.filename for r in kb] == ["a.txt", "b.MD"]
    more = spark.createDataFrame([("  gamma ",), ("   ",)], "text string")
    assert [r.text for r in IO.add_documents(IO.load_text_dir(spark, d), more).collect()][-1] == "gamma"


def test_report_roundtrip_and_fallback(spark):
    base = IO.scratch_path(spark, "test-report")
    t = spark.createDataFrame([("p1", 1.5), ("p2", 2.0)], "phase string, duration_s double")
    IO.save_report({"durations": t}, base, run_id="a")
    back = IO.load_report(spark, base, "durations", "phase string, duration_s double, run string")
    assert {(r.phase, r.run) for r in back.collect()} == {("p1", "a"), ("p2", "a")}
    stored = spark.createDataFrame([("p1", 9.0), ("p3", 3.0)], "phase string, duration_s double")
    merged = {r.phase: r.duration_s for r in IO.recompute_or_stored(t, stored, ["phase"]).collect()}
    assert merged == {"p1": 1.5, "p2": 2.0, "p3": 3.0}


def test_model_save_load(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("target"))
    m = LinearRegression(labelCol="target").fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
    p = IO.save_model(m, IO.scratch_path(spark, "model"))
    loaded = IO.load_model(p)
    assert abs(loaded.coefficients[0] - 2.0) < 1e-6


def test_stored_listing_broadcasts_no_growing_table(spark, smoke_dir):
    # customer and part were broadcast by their compressed size: 97 MB of part rows to the driver, every time
    from sparktab.sources import listing as LS
    plan = LS.raw_listing(spark, smoke_dir, shuffled=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("ShuffledHashJoin") == 2     # nation alone
    tables = LS.stored_listing_pair(spark, smoke_dir)
    for stored, lazy in zip(tables, LS.listing_pair(spark, smoke_dir)):
        assert "Join" not in stored._jdf.queryExecution().executedPlan().toString()
        assert stored.exceptAll(lazy).count() == 0 and lazy.exceptAll(stored).count() == 0
