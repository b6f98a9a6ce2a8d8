"""Run one job: ``python -m stationlake silver --bronze-path ... --silver-path ...``.

Options are the fields of the configuration. ``--silver-days 0`` or ``--gold-days 0`` read
everything, as a first load does. Without ``--run-at`` the run is dated now.
"""

from __future__ import annotations

import argparse
from dataclasses import fields
from datetime import datetime

from stationlake.config import PipelineConfig
from stationlake.plans import incremental, jobs
from stationlake.session import build_session

JOBS = {
    "landing": jobs.run_landing,
    "bronze": jobs.run_bronze_daily,
    "history": jobs.run_bronze_history,
    "silver": jobs.run_silver,
    "gold": jobs.run_gold,
    "incremental": incremental.run_incremental_job,
}


def parse(argv: list[str] | None = None) -> tuple[str, PipelineConfig]:
    parser = argparse.ArgumentParser(prog="stationlake", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    for field in fields(PipelineConfig):
        option = "--" + field.name.replace("_", "-")
        if field.name == "run_at":
            parser.add_argument(option, type=datetime.fromisoformat)
        elif field.name == "polluted_keep":
            parser.add_argument(option, nargs="*")
        elif field.name == "location_ids":
            parser.add_argument(option, nargs="*", type=int)
        elif field.name == "normalise_parameter":
            parser.add_argument(option, action="store_true", default=None)
        else:
            parser.add_argument(option, type=int if field.type == "int" else str)
    given = {k: v for k, v in vars(parser.parse_args(argv)).items() if v is not None}
    job = given.pop("job")
    for name in ("polluted_keep", "location_ids"):
        if name in given:
            given[name] = tuple(given[name])
    return job, PipelineConfig(**given) if "run_at" in given else PipelineConfig.now(**given)


def main(argv: list[str] | None = None) -> None:
    job, cfg = parse(argv)
    spark = build_session(f"stationlake-{job}")
    counts = JOBS[job](spark, cfg)
    if counts is not None:
        for row in counts.toLocalIterator():
            print(row.location_id, row.n_rows)


if __name__ == "__main__":
    main()
