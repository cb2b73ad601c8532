"""Frozen job configuration, held on the driver.

Every time-dependent operator takes ``as_of`` from here (or an explicit
argument) instead of ``current_timestamp()`` so results are repeatable and
identical on task retry.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime


@dataclass(frozen=True)
class Config:
    # Fixed values that must equal the reference's defaults.
    seed: int = 42
    max_samples: int = 25000
    test_size: float = 0.1
    val_size: float = 0.1
    tfidf_max_features: int = 50000
    ngram_max: int = 2
    logreg_C: float = 1.0
    drift_threshold: float = 0.15
    drift_window_days: int = 7
    registry_name: str = "sentiment-model"
    rate_limit_per_minute: int = 60
    rate_window_seconds: int = 60
    max_text_length: int = 5000
    recent_limit: int = 20
    recent_limit_max: int = 200
    listing_limit: int = 50
    runs_per_experiment: int = 50
    transformer_row_cap: int = 5000

    # Fixed values as well: solver limit, and C applies to raw features.
    logreg_max_iter: int = 1000
    logreg_standardize: bool = False

    # Our own choices (documented in README).
    min_df: int = 1
    # Lateness accepted by the rate-flag stream (X4); bounds its keyed state.
    rate_late_delay: str = "1 hour"
    as_of: datetime = datetime(2024, 1, 31)
    reference_end: date = date(2024, 1, 8)
    resolve_before: date = date(2024, 1, 27)
    # 16**4 hash buckets per class for the exact stratified rank.
    split_prefix_hex: int = 4

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


DEFAULT = Config()
