"""The same results when nearly every key is treated as hot and long channel sets are split."""

import pytest

import __spark_entry__ as contract
from streamtally import Settings
from tests.compare import connect, differences
from workload import queries, tables

SF_DIR = "/root/testdata/sf0.001"
TIGHT = Settings(
    hot_key_rows=10, hot_slice_rows=4, pairs_per_piece=3, interval_cell_seconds=600
)
SQL = contract.oracle_sql()
SLICED = [
    "chat_inter_arrival", "chat_channel_hops", "chatter_leaderboard", "donation_deltas", "donation_rank",
    "session_gaps", "category_changes", "title_segments", "mode_changes", "mode_timeline", "session_analysis",
    "emote_usage", "peer_chat", "channel_pair_jaccard", "hourly_network", "bot_signal", "donation_by_title",
    "liveness_reconciliation", "donation_spikes", "chatter_enriched",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def measured(spark, tmp_path_factory):
    """Models whose sequences are cut at measured borders; each is measured once for all tests."""
    return tables.models(spark, SF_DIR, TIGHT).measured(str(tmp_path_factory.mktemp("stats")))


@pytest.mark.parametrize("name", SLICED)
def test_sliced_results_agree(measured, con, name):
    assert differences(queries.comparable(getattr(measured, name)), con, SQL[name]) == []


@pytest.mark.parametrize("name", ["chat_inter_arrival", "chatter_leaderboard", "donation_rank", "mode_timeline", "donation_by_title"])
def test_results_agree_without_statistics(spark, con, name):
    df = queries.comparable(getattr(tables.models(spark, SF_DIR, TIGHT), name))
    assert differences(df, con, SQL[name]) == []


def test_sliced_polls_and_gaps_agree(spark, con):
    from streamtally.plans import quality
    from streamtally.sources import polls
    from workload import raw

    b = tables.base(spark, SF_DIR)
    built = polls.build_metadata_snapshots(*raw.live_streams(b), TIGHT)
    assert differences(queries.comparable(built), con, SQL["build_metadata_snapshots"]) == []
    silent = quality.gaps(tables.models(spark, SF_DIR).stg_chat, "message_sent_at", 60, TIGHT)
    assert differences(queries.comparable(silent), con, SQL["gap_detection_overall"]) == []


def test_slices_follow_the_axis_and_split_one_key(spark):
    from pyspark.sql import functions as F

    from streamtally.operators.ordered import SLICE, slice_hot_keys

    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    cut = slice_hot_keys(rows, ["k"], F.col("id"), Settings(hot_key_rows=100, hot_slice_rows=17))
    sizes = {r[SLICE]: r["n"] for r in cut.groupBy("k", SLICE).agg(F.count("*").alias("n")).where("k = 'hot'").collect()}
    assert len(sizes) == 20 and max(sizes.values()) <= 18
    assert {r[SLICE] for r in cut.where("k <> 'hot'").select(SLICE).distinct().collect()} == {-1}
    ordered = [r[SLICE] for r in cut.where("k = 'hot'").orderBy("id").collect()]
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("axis", ["outlier", "pareto", "equal"])
def test_slices_hold_about_the_same_rows(spark, axis):
    from pyspark.sql import functions as F

    from streamtally.operators.ordered import SLICE, previous_row, slice_hot_keys

    n, target = 4000, 100
    value = {
        "outlier": F.when(F.col("id") == 0, 0).otherwise(F.lit(1_700_000_000_000_000) + F.col("id") * 3_600_000_000),
        "pareto": F.floor(F.lit(1e9) / F.pow(F.lit(n + 1.0) - F.col("id"), 1.2)),
        "equal": F.lit(5),
    }[axis]
    rows = spark.range(n).select(F.lit("hot").alias("k"), value.cast("long").alias("at"), "id")
    cut = slice_hot_keys(rows, ["k"], F.col("at"), Settings(hot_key_rows=1000, hot_slice_rows=target))
    sizes = [r["count"] for r in cut.groupBy(SLICE).count().collect()]
    most_equal = max(r["count"] for r in rows.groupBy("at").count().collect())
    assert max(sizes) <= 2 * max(target, most_equal)
    got = {r["id"]: r["prev"] and r["prev"]["id"] for r in previous_row(cut, ["k"], ["at", "id"], ["id"]).collect()}
    assert got == {i: i - 1 if i else None for i in range(n)}


@pytest.mark.parametrize("axis", ["outlier", "pareto", "equal", "null"])
def test_measured_borders_cut_evenly(spark, tmp_path, axis):
    """Outliers and equal values do not matter: ties are cut by the second column."""
    from pyspark.sql import functions as F

    from streamtally.operators.key_stats import KeyStats
    from streamtally.operators.ordered import SLICE, previous_row, slice_hot_keys

    n, target = 4000, 100
    value = {
        "outlier": F.when(F.col("id") == 0, 0).otherwise(F.lit(1_700_000_000_000_000) + F.col("id") * 50_000_000),
        "pareto": F.floor(F.lit(1e9) / F.pow(F.lit(n + 1.0) - F.col("id"), 1.2)),
        "equal": F.lit(5),
        "null": F.when(F.col("id") < n - 50, F.col("id")),
    }[axis]
    rows = spark.range(n).select(F.lit("hot").alias("k"), value.cast("long").alias("at"), "id")
    rows = rows.unionByName(spark.range(30).select(F.col("id").cast("string").alias("k"), F.col("id").alias("at"), "id"))
    settings = Settings(hot_key_rows=1000, hot_slice_rows=target, key_stats=KeyStats(str(tmp_path)))
    cut = slice_hot_keys(rows, ["k"], F.col("at"), settings, name="numbers", ties=["id"])
    sizes = {r[SLICE]: r["count"] for r in cut.where("k = 'hot'").groupBy(SLICE).count().collect()}
    assert max(sizes.values()) <= target and len(sizes) >= n // target
    assert {r[SLICE] for r in cut.where("k <> 'hot'").collect()} == {-1}
    got = {r["id"]: r["prev"] and r["prev"]["id"] for r in previous_row(cut, ["k"], ["at", "id"], ["id"]).where("k = 'hot'").collect()}
    assert got == {i: i - 1 if i else None for i in range(n)}
    # Without a key, and without a hot one.
    alone = slice_hot_keys(rows.where("k = 'hot'"), [], F.col("at"), settings, name="alone", ties=["id"])
    assert max(r["count"] for r in alone.groupBy(SLICE).count().collect()) <= target
    calm = slice_hot_keys(rows.where("k <> 'hot'"), ["k"], F.col("at"), settings, name="calm", ties=["id"])
    assert calm.select(SLICE).distinct().collect() == [(-1,)] and "Join" not in calm._jdf.queryExecution().optimizedPlan().toString()
