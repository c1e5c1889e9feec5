"""Relational operators shared by the plans."""

from shelftrack.operators.aggregates import (
    duplicate_keys, first_per_key, group_stats, high_watermark, merged_statistics, moments, price_statistics, upper_outliers,
)
from shelftrack.operators.generators import date_spine
from shelftrack.operators.joins import attach_group_max, left_join_dim, missing_in, present_in, skew_join
from shelftrack.operators.ranking import latest_per_key, latest_per_key_per_day, per_source_cap, sample_per_source, top_k
from shelftrack.operators.upsert import full_refresh, newer_than, upsert, upsert_table

__all__ = [
    "attach_group_max", "date_spine", "duplicate_keys", "first_per_key", "full_refresh",
    "group_stats", "high_watermark", "latest_per_key", "latest_per_key_per_day",
    "left_join_dim", "merged_statistics", "missing_in", "moments", "newer_than", "per_source_cap", "present_in",
    "price_statistics", "sample_per_source", "skew_join", "top_k", "upper_outliers", "upsert", "upsert_table",
]
