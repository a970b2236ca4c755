"""DataFrame operators: cleaning, checks, features, metrics, profiles, quality."""

from loanframe.operators.checks import (
    category_violations,
    output_gate,
    output_row_counts,
    raise_on_violations,
    require_non_empty,
    validate_categoricals,
)
from loanframe.operators.clean import (
    cast_numbers,
    cast_sparse_numerics,
    clean_dates,
    clean_raw,
    clean_sparse,
    clean_term,
    drop_member_id,
    drop_shifted_rows,
    preview,
    split_shifted_rows,
)
from loanframe.operators.features import (
    add_delinquency_flag,
    add_dti_bucket,
    add_features,
    add_loan_age,
    add_vintage_year,
    default_label,
    is_resolved,
    label_target,
)
from loanframe.operators.metrics import (
    default_rate_curve,
    label_distribution,
    npl_ratio,
    npl_ratio_by_dimensions,
)
from loanframe.operators.profile import (
    dataset_profile,
    fill_rates,
    sample_rows,
    sparse_block_fill,
    status_profile,
    top_values,
    value_counts,
    value_profile,
)
from loanframe.operators.quality import (
    batch_counts,
    batch_stats,
    checkpoint_metrics,
    distribution_snapshot,
    drift,
    funnel_rows,
    null_rates,
    null_rates_of,
    raw_width,
    report_rows,
    row_count_delta,
    row_count_delta_from_stats,
    row_count_delta_of,
    row_count_of,
    snapshot_of,
    stage_funnel,
)
from loanframe.operators.ranking import ranked

__all__ = [name for name in dir() if not name.startswith("_")]
