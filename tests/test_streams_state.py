"""Stateful streams over many files in any order: nothing is lost, and runs go on where they stopped."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparktab.operators.events import pair_start_end
from sparktab.sources.eventlog import event_log_of
from sparktab.streaming import jobs as S

T0 = dt.datetime(2024, 1, 1)


def make_events(n, seed, hot=0.4):
    """Events of 12 users, one of them hot; seq counts up with time, times may repeat."""
    rng = random.Random(seed)
    at, rows = 0, []
    for i in range(n):
        at += rng.choice([0, 1, 60, 900, 3600, 40_000])
        user = 0 if rng.random() < hot else rng.randint(1, 11)
        rows.append((i, T0 + dt.timedelta(seconds=at), user, rng.choice(["signup", "purchase", "click"]), rng.choice([1.0, 50.0, None, -1.0]), '{"k": 1}'))
    return rows


def write_files(spark, folder, rows, files, seed):
    """``files`` Parquet files of rows in random order, all in one folder."""
    rows = rows[:]
    random.Random(seed).shuffle(rows)
    for i in range(files):
        spark.createDataFrame(rows[i::files], S.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def batch_pairs(spark, rows):
    out = pair_start_end(event_log_of(spark.createDataFrame(rows, S.EVENTS_SCHEMA)))
    return sorted((r.phase, r.seq, r.duration_s, r.status) for r in out.collect())


def stream_rows(df):
    return sorted((r.phase, r.seq, r.duration_s, r.status) for r in df.where("status <> 'timeout'").collect())


def timeouts(rows, timeout_s=86400, lateness_s=3600):
    """Starts that are their phase's last event and old enough."""
    last = {}
    pe = [r for r in rows if r[3] in ("signup", "purchase")]
    for r in pe:
        last[r[2] % 12] = r
    now = max(r[1] for r in pe)
    return sorted((f"phase_{p}", r[0]) for p, r in last.items()
                  if r[3] == "signup" and r[1] + dt.timedelta(seconds=timeout_s + lateness_s) < now)


@pytest.mark.parametrize("block_s", [1800, 86400])
def test_pairs_of_shuffled_files_equal_the_batch(spark, tmp_path, block_s):
    rows = make_events(400, block_s)
    write_files(spark, str(tmp_path / "events"), rows, 8, 1)
    out = S.stream_phase_pairs(spark, str(tmp_path / "events"), block_s=block_s, max_files_per_trigger=1).cache()
    assert stream_rows(out) == batch_pairs(spark, rows)
    assert sorted((r.phase, r.seq) for r in out.where("status = 'timeout'").collect()) == timeouts(rows)


def test_pairs_go_on_from_the_folder(spark, tmp_path):
    rows = make_events(200, 3)
    src, folder = str(tmp_path / "events"), str(tmp_path / "run")
    write_files(spark, src, rows[:120], 2, 1)
    assert stream_rows(S.stream_phase_pairs(spark, src, folder=folder)) == batch_pairs(spark, rows[:120])
    write_files(spark, src, rows[120:], 2, 2)
    assert stream_rows(S.stream_phase_pairs(spark, src, folder=folder)) == batch_pairs(spark, rows)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_state_of_a_task_is_one_block():
    # a phase's events spread over blocks: what one call sees is a block, whatever the phase sums up to
    ev = pd.DataFrame({"seq": range(6), "us": [10, 20, 30, 40, 50, 60], "is_start": [False, True, True, False, False, True],
                       "status": ["a", None, None, "b", "c", None]})
    out = S.pair_block(ev.sample(frac=1, random_state=1))
    assert out["kind"].tolist() == ["first", "pair", "pair", "open"]
    assert out["seq"].tolist() == [0, 3, 4, 5]
    assert [None if pd.isna(x) else int(x) for x in out["start_us"]] == [None, 30, None, 60]
    assert S.pair_block(pd.concat([ev, ev])).equals(out)


def test_guard_checks_every_event_once(spark, tmp_path):
    rows = make_events(300, 5)
    again = random.Random(2).sample(rows, 120)
    src = str(tmp_path / "events")
    write_files(spark, src, rows + again, 7, 3)
    out = S.stream_guard(spark, src, max_files_per_trigger=2)
    total = {r.check: r.v for r in out.groupBy("check").agg(F.sum("value").alias("v")).collect()}
    assert out.select("batch_id").distinct().count() == 4
    assert total == {"rows": 300, "null_values": sum(r[4] is None for r in rows), "negative_values": sum(r[4] == -1.0 for r in rows)}


def test_guard_goes_on_and_looks_back_as_far_as_asked(spark, tmp_path):
    rows = make_events(100, 6)
    src, folder = str(tmp_path / "events"), str(tmp_path / "run")
    write_files(spark, src, rows, 2, 3)
    def checked(**kw):
        return S.stream_guard(spark, src, folder=folder, **kw).where("check = 'rows'").agg(F.sum("value")).first()[0]
    assert checked() == 100
    write_files(spark, src, rows, 1, 4)       # all again: nothing new
    assert checked() == 100
    write_files(spark, src, rows, 1, 5)       # only the last two hours are looked at: older events count as new
    recent = max(r[1] for r in rows) - dt.timedelta(hours=2)
    assert checked(ttl_blocks=2) == 200 - sum(r[1].replace(minute=0, second=0) >= recent.replace(minute=0, second=0) for r in rows)


def test_streams_of_one_file(spark, smoke_dir):
    assert S.stream_source_path(spark, smoke_dir + "/events.parquet").endswith("[t]")
    assert S.stream_source_path(spark, smoke_dir) == smoke_dir
