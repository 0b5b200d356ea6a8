"""Airindex: air-quality analytics as Spark DataFrame operators.

The most used entry points, importable from the package root.
"""

from airindex.operators.changepoints import Model, fit_changepoints, forecast_changepoints, vietnamese_calendar
from airindex.operators.conform import flatten_measurements, raw_payload, with_date_parts
from airindex.operators.forecast import forecast_fourier, forecast_linear
from airindex.operators.numbering import number_rows, rolling_rows_dense
from airindex.operators.patterns import (lagged_correlation, pattern_by, pollutant_correlation,
                                         rank_correlation, rollup_year_month, share_by)
from airindex.operators.quality import (completeness_by_day, coverage_gaps, high_water_mark,
                                        issue_log, kpi_summary, status_counts, trend_series)
from airindex.operators.rolling import rolling_mean, rolling_rows, rolling_seconds
from airindex.operators.rollup import daily_rollup
from airindex.operators.series import (clip_columns, future_frame, last_n, last_observation,
                                       mask_outliers, to_series, top_n, with_anchor)
from airindex.operators.star import dim_date, dim_date_spanning, star_join, star_report
from airindex.operators.upsert import (affected_dates, as_of, evolve_union, latest_per_key,
                                       merge_frames, replace_by_key, upsert_partitioned)
from airindex.operators.validity import as_of_join, gap_ranges, state_changes, validity
from airindex.plans.daily import daily_air_index, daily_pm_index, two_day_buffer
from airindex.plans.incremental import refresh_daily_fact
from airindex.session import build_session

__all__ = [
    "Model", "affected_dates", "as_of", "as_of_join", "build_session", "clip_columns", "completeness_by_day",
    "coverage_gaps", "daily_air_index", "daily_pm_index", "daily_rollup", "dim_date",
    "dim_date_spanning", "evolve_union", "fit_changepoints", "flatten_measurements", "forecast_changepoints",
    "forecast_fourier", "forecast_linear", "future_frame", "gap_ranges", "high_water_mark", "issue_log",
    "kpi_summary", "lagged_correlation", "last_n",
    "last_observation", "latest_per_key", "mask_outliers", "merge_frames", "number_rows", "pattern_by",
    "pollutant_correlation", "rank_correlation", "raw_payload", "refresh_daily_fact", "replace_by_key",
    "rolling_mean", "rolling_rows", "rolling_rows_dense", "rolling_seconds", "rollup_year_month",
    "share_by", "star_join", "star_report", "state_changes", "status_counts", "to_series", "top_n",
    "trend_series", "two_day_buffer",
    "upsert_partitioned", "validity", "vietnamese_calendar", "with_anchor", "with_date_parts",
]
