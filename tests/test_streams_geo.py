from pyspark.sql import functions as F

from sparktab.operators import text as TX


def test_stream_windows_only_closed(spark, smoke_dir):
    import __spark_entry__ as E
    out = E.queries()["stream_event_windows"](spark, smoke_dir).toPandas()
    assert len(out) > 0 and (out.calls > 0).all()
    # windows are whole days aligned to the epoch
    assert (out.window_start % 86400 == 0).all()


def test_stream_pairs_match_batch_pairing(spark, smoke_dir):
    import __spark_entry__ as E
    s = E.queries()["stream_pairs"](spark, smoke_dir).where(F.col("status") != "timeout")
    b = E.queries()["phase_durations"](spark, smoke_dir)
    got = {(r.phase, r.seq): r.duration_s for r in s.collect()}
    exp = {(r.phase, r.seq): r.duration_s for r in b.collect()}
    assert got == exp


def test_geo_cluster_invariants(spark, smoke_dir):
    from sparktab.operators.geo import create_geo_features, fit_geo
    from sparktab.sources.listing import listing, listing_pair
    train, test = listing_pair(spark, smoke_dir)
    out = fit_geo(train, n_clusters=4, n_init=2)(test).toPandas()
    assert set(out.geo_cluster) <= set(range(4)) and (out.geo_dist_center >= 0).all() and (out.geo_dist_cluster >= 0).all()
    t = create_geo_features(listing(spark, smoke_dir), n_clusters=3, n_init=1).toPandas()
    nulls = t[t.lat.isna() | t.lon.isna()]
    assert (nulls.geo_cluster == -1).all() and (nulls.geo_dist_to_center == 0).all()
    assert set(t.geo_cluster) <= {-1, 0, 1, 2}


def test_chunks_overlap(spark):
    words = " ".join(f"w{i}" for i in range(1000))
    df = spark.createDataFrame([(1, words)], "id long, t string")
    ch = TX.chunk_words(df, "id", "t", size=512, overlap=50).orderBy("chunk").collect()
    assert [r.n_words for r in ch] == [512, 512, 76]
    assert ch[1].text.split()[0] == "w462"


def test_stream_pairs_timeout_for_open_start(spark):
    import datetime as dt
    import tempfile

    from sparktab.streaming import jobs as S
    d = tempfile.mkdtemp(prefix="sparktab-x2-")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0, 0, "signup", 1.0, '{"k": 1}'),                              # phase_0 start, never ended
            (2, t0 + dt.timedelta(days=3), 1, "signup", 1.0, '{"k": 1}'),        # phase_1 start
            (3, t0 + dt.timedelta(days=3, seconds=30), 1, "purchase", 50.0, '{"k": 1}')]
    spark.createDataFrame(rows, S.EVENTS_SCHEMA).write.parquet(d + "/events")
    out = {r.phase: (r.seq, r.status, r.duration_s) for r in S.stream_phase_pairs(spark, d + "/events").collect()}
    assert out["phase_0"] == (1, "timeout", None)
    assert out["phase_1"] == (3, "failed", 30.0)
