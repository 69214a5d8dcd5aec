"""Every threshold and physical knob in one frozen value."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from streamtally.operators.key_stats import KeyStats


@dataclass(frozen=True)
class Settings:
    # Chatter profile: number of channels up to which a chatter keeps the label.
    sedentary_max_channels: int = 1
    multi_streamer_max_channels: int = 3
    semi_nomad_max_channels: int = 10
    # Two messages in two channels within this many minutes make one hop.
    hop_max_gap_minutes: int = 30
    mood_min_messages: int = 20
    spike_z: float = 2.0
    bot_min_gaps: int = 5
    top_spikes: int = 200
    asof_lookback_seconds: int = 300
    network_min_shared: int = 3
    leaderboard_top: int = 10
    opening_until: float = 0.2
    middle_until: float = 0.8
    quarter_hour_lookback_minutes: int = 15
    freshness_warn_minutes: int = 15
    freshness_error_minutes: int = 60
    # "Now" of the account-age buckets; fixed by the caller so reruns agree.
    as_of: dt.datetime = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

    # Physical knobs.
    # A key with more rows than this has its ordered sequence cut into slices of about hot_slice_rows rows.
    # At most rows/hot_key_rows keys can qualify, which bounds the hot-key table.
    hot_key_rows: int = 5_000_000
    hot_slice_rows: int = 1_000_000
    # Up to this many batch ids of a micro-batch are looked up through a filter pushed to the files.
    pushed_ids: int = 1000
    # Parts of the ingest's replay index, by hash of the batch id, and of the state of previous-row streams, by key.
    replay_buckets: int = 64
    state_buckets: int = 16
    # Channel pairs one row may fan out to before its work is split over more rows.
    pairs_per_piece: int = 50_000
    # Width of the time cell in interval joins.
    interval_cell_seconds: int = 3600
    # Where hot keys and their borders are measured and kept; without it every plan finds them itself.
    key_stats: KeyStats | None = field(default=None, compare=False)
