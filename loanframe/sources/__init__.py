"""Sources and sinks: raw CSV, Parquet checkpoint, curated tables, baseline
snapshot, and the loan-shaped view over the test tables."""

from loanframe.sources.files import (
    load_baseline,
    load_json_baseline,
    read_checkpoint,
    read_raw_csv,
    remove_scratch,
    save_baseline,
    scratch_path,
    scratch_table,
    shared_dir,
    string_schema,
    write_checkpoint,
    write_csv,
    write_table,
)
from loanframe.sources.releases import (
    Release,
    all_releases,
    discard_run,
    latest_release,
    publish_run,
    stage_run,
)
from loanframe.sources.tpch_loans import loan_view

__all__ = [
    "Release",
    "all_releases",
    "discard_run",
    "latest_release",
    "publish_run",
    "stage_run",
    "load_baseline",
    "load_json_baseline",
    "loan_view",
    "read_checkpoint",
    "read_raw_csv",
    "remove_scratch",
    "save_baseline",
    "scratch_path",
    "scratch_table",
    "shared_dir",
    "string_schema",
    "write_checkpoint",
    "write_csv",
    "write_table",
]
