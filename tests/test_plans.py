"""Physical plans: what must not be in any of them, and what must be."""

import re

import pytest

import __spark_entry__ as contract
from workload import queries, tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Windows without a partition key: only over event phases, days, slices of hot sequences,
# and whole-event sequences short enough not to be cut.
GLOBAL_WINDOWS = {"event_phase_totals", "retention_curve"}


@pytest.mark.parametrize("name", queries.MODELS)
def test_no_products_no_python_no_global_windows(spark, name):
    text = plan(getattr(tables.models(spark, SF_DIR), name))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text
    for window in re.findall(r"Window \[.*", text):
        keys = re.search(r"specifiedwindowframe.*\) AS [^\]]*\], \[([^\]]*)\]", window)
        assert name in GLOBAL_WINDOWS or (keys and ("#" in keys.group(1) or "_slice" in window))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(tables.models(spark, SF_DIR).stream_sessions)
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(part.split(":")[0] for part in scan.split(",")) == ["event_type", "props", "ts", "user_id", "value"]
    assert re.search(r"PushedFilters: \[[^\]]*event_type", text)


def test_spike_join_limits_first(spark):
    text = plan(tables.models(spark, SF_DIR).donation_spikes)
    assert "TakeOrderedAndProject(limit=200" in text


SCANS = {"mode_timeline": 1, "donation_deltas": 1, "donation_rank": 2, "donation_by_title": 2, "donation_spikes": 5, "chatter_leaderboard": 6}


@pytest.mark.parametrize("name", SCANS)
def test_planned_scans(spark, tmp_path, name):
    """With measured keys no sequence reads its input again to find them."""
    found = len(re.findall(r"FileScan parquet", plan(getattr(tables.models(spark, SF_DIR).measured(str(tmp_path)), name)).split("== Initial Plan ==")[-1]))
    assert found <= SCANS[name]


def test_laid_out_tables_are_not_shuffled(spark, tmp_path):
    """Days are folders; join and grouping by channel and hour find their rows in place."""
    from pyspark.sql import functions as F

    from streamtally.plans import layout

    m = tables.models(spark, SF_DIR)
    chat = layout.lay_out(m.stg_chat.select("channel", "message_sent_at"), "channel", "message_sent_at", str(tmp_path / "chat"), 4, m.settings)
    spans = m.stream_sessions.select("channel", "stream_started_at", "first_seen_at", "last_seen_at")
    placed = layout.lay_out_spans(spans, "channel", "first_seen_at", "last_seen_at", str(tmp_path / "spans"), 4, m.settings)
    hours = plan(layout.hourly_messages(chat, "2024-01-02", "2024-01-02"))
    assert "Exchange" not in hours and re.search(r"PartitionFilters: \[[^\]]*event_day", hours) and "Bucketed: true" in hours
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = plan(layout.session_talk(chat, placed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = met[met.index("SortMergeJoin") :]
    assert "Exchange" not in below and below.count("Bucketed: true") == 2
    assert chat.where(F.col("event_day") == "2024-01-02").count() == m.stg_chat.where(F.to_date("message_sent_at") == "2024-01-02").count()


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path):
    """A file of a few MB holds millions of equal rows; read into the driver's memory they would not fit."""
    from streamtally.session import configure

    configure(spark).range(2_000_000).selectExpr("id", "'some text' as t").write.parquet(str(tmp_path / "large"))
    large = spark.read.parquet(str(tmp_path / "large"))
    assert "BroadcastHashJoin" not in plan(large.join(large.withColumnRenamed("t", "u"), "id"))


def test_coverage_repeats_the_channels_not_the_catalog(spark):
    text = plan(tables.models(spark, SF_DIR).emote_catalog_coverage)
    repeated = re.findall(r"Generate .*, \[([^\]]*)\], false, \[_salt#", text)
    assert repeated and not any("emote_id" in columns for columns in repeated)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_rules_work_through_the_sources_once(spark, tmp_path, monkeypatch):
    """Only the staging models read the sources; all others read models that were written before them, each once."""
    from streamtally import Models
    from streamtally.plans import quality

    read, real = {}, Models.materialize

    def watched(self, names, root, *more):
        names = list(names)
        read.update({n: {f.split("/")[-2 if "/models/" in f else -1] for f in getattr(self, n).inputFiles()} for n in names if n not in read})
        return real(self, names, root, *more)

    monkeypatch.setattr(Models, "materialize", watched)
    rules = [r for r in quality.RULES if r.model in ("stg_chat", "mode_changes", "donation_rank_hourly", "bot_signal", "chatter_enriched", "chatter_profile")]
    quality.stage(tables.models(spark, SF_DIR), str(tmp_path / "models"), rules)
    assert {n for n, files in read.items() if files & {"events.parquet", "part.parquet"}} == set(quality.SHARED[0])
    assert read["mode_changes"] == read["donation_rank_hourly"] == {"stg_snapshots"} and read["chatter_profile"] == {"chatter_rollup"}
    assert read["bot_signal"] == read["chatter_enriched"] == {"chatter_rollup", "chatter_regularity"}
    assert {r.model for r in rules} <= set(read)
