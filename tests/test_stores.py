"""Writers and readers of bronze tables."""

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from streamtally import Settings
from streamtally.plans import chatters, quality
from streamtally.sources import stores
from tests.test_edges import T0, at, messages

S = Settings()


def test_append_drops_replays_and_repeats(spark):
    ddl = "batch_id string, row_number int, v string"
    target = spark.createDataFrame([("a", 0, "old"), ("b", 0, "old")], ddl)
    batch = spark.createDataFrame([("a", 0, "again"), ("a", 1, "new"), ("c", 0, "new"), ("c", 0, "new")], ddl)
    fresh = stores.append_dedup(target, batch, S)
    assert sorted((r["batch_id"], r["row_number"], r["v"]) for r in fresh.collect()) == [("a", 1, "new"), ("c", 0, "new")]
    assert stores.rows_merged(fresh).collect()[0]["rows_merged"] == 2
    joined = stores.append_dedup(target, batch, Settings(pushed_ids=1))
    assert sorted(joined.collect()) == sorted(fresh.collect())


def test_replay_check_reaches_the_files(spark, tmp_path):
    ddl = "batch_id string, row_number int, v string"
    spark.createDataFrame([("a", 0, "old")], ddl).write.parquet(str(tmp_path / "t"))
    target = spark.read.schema(ddl).parquet(str(tmp_path / "t"))
    fresh = stores.append_dedup(target, spark.createDataFrame([("a", 0, "x"), ("b", 0, "y")], ddl), S)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "In(batch_id, [a,b])" in plan or "In(batch_id, [b,a])" in plan
    assert [r["v"] for r in fresh.collect()] == ["y"]


def test_upsert_keeps_latest_and_absent_keys(spark):
    ddl = "k string, code string, fetched_at timestamp"
    target = spark.createDataFrame([("a", "1", at(0)), ("gone", "1", at(0)), ("late", "new", at(100))], ddl)
    batch = spark.createDataFrame([("a", "2", at(5)), ("a", "3", at(9)), ("late", "old", at(1)), ("new", "1", at(1))], ddl)
    merged = stores.upsert_latest(target, batch, ["k"], "fetched_at")
    assert {r["k"]: (r["code"], r["fetched_at"]) for r in merged.collect()} == {
        "a": ("3", at(9)), "gone": ("1", at(0)), "late": ("new", at(100)), "new": ("1", at(1))
    }


def test_upsert_prefers_the_batch_at_equal_clocks(spark):
    ddl = "k string, code string, fetched_at timestamp, pos int"
    target = spark.createDataFrame([("a", "old", at(0), 0)], ddl)
    batch = spark.createDataFrame([("a", "second", at(0), 2), ("a", "first", at(0), 1)], ddl)
    (row,) = stores.upsert_latest(target, batch, ["k"], "fetched_at", F.col("pos")).collect()
    assert row["code"] == "second"


def test_rolling_files(spark, tmp_path):
    stores.write_rolling_parquet(spark.range(250).coalesce(1), str(tmp_path / "out"), 100)
    files = list(Path(tmp_path / "out").glob("*.zstd.parquet"))
    sizes = sorted(spark.read.parquet(str(f)).count() for f in files)
    assert sizes == [50, 100, 100]


def test_old_files_lack_later_columns(spark, tmp_path):
    messages(spark, [{"message_text": "x"}]).select("id", "channel", "message_text").write.parquet(str(tmp_path / "live_chat"))
    (row,) = stores.scan_bronze(spark, str(tmp_path), "live_chat").collect()
    assert (row["channel"], row["emotes"], row["badges"]) == ("a", None, None)


def test_synthetic_channels(spark):
    rows = messages(spark, [{"channel": "stress-test-1"}, {"channel": "real"}])
    assert [r["channel"] for r in stores.without_synthetic(rows).collect()] == ["real"]


def test_incremental_quarter_hours_replace_the_lookback_only(spark):
    first = [{"chatter_id": "x", "message_sent_at": at(60 * m)} for m in (0, 16, 31)]
    later = [*first, {"chatter_id": "x", "message_sent_at": at(60 * 32)}, {"chatter_id": "x", "message_sent_at": at(60 * 46)},
             {"chatter_id": "x", "message_sent_at": at(60 * 1)}]
    existing = chatters.quarter_hours(messages(spark, first))
    after = chatters.refresh_quarter_hours(existing, messages(spark, later), S)
    # The late message of minute 1 lies before the lookback and is left for a full rebuild.
    assert sorted((r["quarter_hour_bucket"], r["message_count"]) for r in after.collect()) == [
        (T0, 1), (at(900), 1), (at(1800), 2), (at(2700), 1)
    ]


def test_incremental_runs_rewrite_the_days_of_the_lookback(spark, tmp_path):
    day, midnight = 86_400, 86_400 - T0.hour * 3600 - T0.minute * 60
    table = chatters.quarter_hour_table(spark, str(tmp_path / "t"))
    when = lambda seconds: at(midnight + seconds)
    sent = [{"chatter_id": "x", "message_sent_at": when(k * day + 7)} for k in range(3)]
    first = (T0 - dt.datetime(1970, 1, 1, tzinfo=T0.tzinfo)).days + 1
    assert chatters.store_quarter_hours(table, messages(spark, sent), S) == [first, first + 1, first + 2]
    more = [*sent, {"chatter_id": "y", "message_sent_at": when(2 * day + 8)}, {"chatter_id": "x", "message_sent_at": when(3 * day)}, {"chatter_id": "x", "message_sent_at": when(9)}]
    # The lookback reaches into the day before the newest bucket, which starts its day.
    assert chatters.store_quarter_hours(table, messages(spark, more), S) == [first + 1, first + 2, first + 3]
    assert sorted((r["chatter_id"], r["quarter_hour_bucket"], r["message_count"]) for r in table.read().collect()) == [
        ("x", when(0), 1), ("x", when(day), 1), ("x", when(2 * day), 1), ("x", when(3 * day), 1), ("y", when(2 * day), 1)
    ]
    assert chatters.store_quarter_hours(table, messages(spark, more), S) == [first + 2, first + 3]


def test_freshness_levels(spark):
    rows = messages(spark, [{"ingested_at": T0}])
    for minutes, status in ((15, "pass"), (16, "warn"), (60, "warn"), (61, "error")):
        now = F.lit(T0 + dt.timedelta(minutes=minutes))
        assert quality.freshness(rows, "ingested_at", S, now).collect()[0]["status"] == status
    assert quality.freshness(rows.limit(0), "ingested_at", S).collect()[0]["status"] == "error"
