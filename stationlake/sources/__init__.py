"""Readers and writers of the landing, bronze, silver and gold layers."""

from stationlake.sources.ledger import (
    changed_days,
    file_fingerprints,
    new_files,
    record_days,
    record_files,
    record_taken,
)
from stationlake.sources.readers import (
    read_bronze_window,
    read_history_csv,
    read_history_records,
    read_landing,
    read_landing_records,
    read_payload,
    read_silver_window,
    read_table,
    rejected_counts,
    split_records,
)
from stationlake.sources.writers import (
    append_bucketed,
    append_days,
    append_history,
    merge_catalog_table,
    overwrite_days,
    register_partition,
    remove_partitions,
    replace_catalog_window,
    replace_window,
    set_aside,
    write_bronze_day,
    write_landing,
)

__all__ = [
    "append_bucketed",
    "append_days",
    "append_history",
    "changed_days",
    "file_fingerprints",
    "merge_catalog_table",
    "new_files",
    "overwrite_days",
    "read_bronze_window",
    "read_history_csv",
    "read_history_records",
    "read_landing",
    "read_landing_records",
    "read_payload",
    "read_silver_window",
    "read_table",
    "record_days",
    "record_files",
    "record_taken",
    "register_partition",
    "rejected_counts",
    "remove_partitions",
    "replace_catalog_window",
    "replace_window",
    "set_aside",
    "split_records",
    "write_bronze_day",
    "write_landing",
]
