"""Column expressions shared by the operators."""

from stationlake.functions.columns import (
    any_null,
    day_key,
    day_number,
    map_batches,
    normalise_code,
    quoted,
    unused,
)

__all__ = ["any_null", "day_key", "day_number", "map_batches", "normalise_code", "quoted", "unused"]
