"""Operators: functions from DataFrames to DataFrames, without I/O of their own."""

from stationlake.operators.checks import observe_readings, observed_counts
from stationlake.operators.conform import (
    canonical_station,
    canonical_station_as_of,
    conform_readings,
    describe_parameter,
    filter_polluted_id,
    tag_ingestion,
)
from stationlake.operators.dedupe import dedupe_readings
from stationlake.operators.extremes import (
    daily_extremes,
    daily_extremes_joined,
    daily_sensor_dims,
)
from stationlake.operators.landing import (
    flatten_drifting_payload,
    flatten_payload,
    landed_counts,
)
from stationlake.operators.merge import (
    days_met,
    merge_insert_only,
    replace_days,
    rows_met,
    split_valid,
)
from stationlake.operators.ranking import first_k, rank_asc, rank_desc
from stationlake.operators.windows import event_day_window, ingestion_window, rolling_interval

__all__ = [
    "canonical_station",
    "canonical_station_as_of",
    "conform_readings",
    "daily_extremes",
    "daily_extremes_joined",
    "daily_sensor_dims",
    "days_met",
    "dedupe_readings",
    "describe_parameter",
    "event_day_window",
    "filter_polluted_id",
    "first_k",
    "flatten_drifting_payload",
    "flatten_payload",
    "ingestion_window",
    "landed_counts",
    "merge_insert_only",
    "observe_readings",
    "observed_counts",
    "rank_asc",
    "rank_desc",
    "replace_days",
    "rolling_interval",
    "rows_met",
    "split_valid",
    "tag_ingestion",
]
