"""End-to-end jobs: batch (P1), quality (P2), profiling."""

from loanframe.plans.batch import BatchResult, prepare_loans, run_batch
from loanframe.plans.profiling import profiled_loans, run_profiling
from loanframe.plans.publish import (
    malformed_lines,
    publish_batch,
    read_release,
    rejected_rows,
    row_audit,
)
from loanframe.plans.quality import QualityResult, run_quality

__all__ = [
    "BatchResult",
    "QualityResult",
    "malformed_lines",
    "prepare_loans",
    "profiled_loans",
    "publish_batch",
    "read_release",
    "rejected_rows",
    "row_audit",
    "run_batch",
    "run_profiling",
    "run_quality",
]
