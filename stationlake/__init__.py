"""Spark operators and daily jobs for a lakehouse of station sensor readings."""

from stationlake.config import PipelineConfig

__all__ = ["PipelineConfig"]
