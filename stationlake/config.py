"""Job parameters, including the clock: nothing else in the package reads the time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from zoneinfo import ZoneInfo

# The station id under which two sites report, and the raw names of the site to keep.
POLLUTED_ID = 3911519
POLLUTED_KEEP = ("Parque Vida Nova, Caji", "Parque Vida Nova, Caji-3892884")

ZONE = "America/Sao_Paulo"


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a job needs besides the session.

    ``run_at`` is taken once and every part of a run derives from it, so a run that crosses
    midnight still reads, tags and registers one day.
    """

    run_at: datetime
    payload_path: str = ""
    landing_path: str = ""
    history_path: str = ""
    bronze_path: str = ""
    silver_path: str = ""
    gold_path: str = ""
    # rows with a NULL key go here; without it they are inserted again at every run
    quarantine_path: str = ""
    # what earlier runs have done; without it history is loaded anew at every run
    ledger_path: str = ""
    # stations to land; all in the payload, if none is given
    location_ids: tuple[int, ...] = ()
    # catalog table over bronze_path: told about new partitions, and read by silver
    bronze_table: str | None = None
    # tables of a format with row-level changes; they take the place of the paths
    silver_table: str | None = None
    gold_table: str | None = None
    # a catalog table of files that takes the place of silver_path, bucketed by the merge's key
    silver_bucketed: str | None = None
    silver_buckets: int = 64
    timezone: str = ZONE
    days_back: int = 3
    silver_days: int = 3
    gold_days: int = 3
    k: int = 3
    polluted_id: int = POLLUTED_ID
    polluted_keep: tuple[str, ...] = POLLUTED_KEEP
    normalise_parameter: bool = False
    # "insert_only" freezes a day at its first gold run; "replace_days" recomputes the window;
    # "changed_days" recomputes the days that silver has touched since, which takes a ledger
    gold_mode: str = "insert_only"

    def __post_init__(self) -> None:
        if self.gold_mode not in ("insert_only", "replace_days", "changed_days"):
            raise ValueError(f"unknown gold_mode: {self.gold_mode}")
        if self.gold_mode == "changed_days" and not (self.ledger_path and self.gold_path):
            raise ValueError("changed_days takes a ledger_path and a gold_path")

    @classmethod
    def now(cls, timezone: str = ZONE, **kwargs) -> PipelineConfig:
        """A configuration for a run that starts at this moment."""
        return cls(run_at=datetime.now(ZoneInfo(timezone)), timezone=timezone, **kwargs)

    @property
    def local_run_at(self) -> datetime:
        """The run instant as wall-clock time in the pipeline's zone."""
        zone = ZoneInfo(self.timezone)
        if self.run_at.tzinfo is None:
            return self.run_at.replace(tzinfo=zone)
        return self.run_at.astimezone(zone)

    @property
    def run_date(self) -> date:
        return self.local_run_at.date()
