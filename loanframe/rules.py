"""Default rule tables.

FIXED VALUES: the constants in this module must equal the source job's rule tables
for results to match (raw column names, category domain, patterns, date format,
thresholds and labels, report column lists).  They are stated as plain text in
their natural order.
"""

from __future__ import annotations

# --- FIXED VALUES -------------------------------------------------------------

# Raw columns holding "Mon-YYYY" strings.
DATE_COLUMNS = (
    "issue_d",
    "earliest_cr_line",
    "last_pymnt_d",
    "next_pymnt_d",
    "last_credit_pull_d",
)
DATE_FORMAT = "MMM-yyyy"
# Three letters, a dash, four digits.
DATE_PATTERN = r"^[A-Za-z]{3}-\d{4}$"

# Sparse blocks (mostly-null raw columns), by block.
HARDSHIP_COLUMNS = (
    "hardship_flag",
    "hardship_type",
    "hardship_reason",
    "hardship_status",
    "deferral_term",
    "hardship_amount",
    "hardship_start_date",
    "hardship_end_date",
    "payment_plan_start_date",
    "hardship_length",
    "hardship_dpd",
    "hardship_loan_status",
    "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount",
    "hardship_last_payment_amount",
)
SETTLEMENT_COLUMNS = (
    "debt_settlement_flag",
    "debt_settlement_flag_date",
    "settlement_status",
    "settlement_date",
    "settlement_amount",
    "settlement_percentage",
    "settlement_term",
)
SEC_APP_COLUMNS = (
    "sec_app_fico_range_low",
    "sec_app_fico_range_high",
    "sec_app_earliest_cr_line",
    "sec_app_inq_last_6mths",
    "sec_app_mort_acc",
    "sec_app_open_acc",
    "sec_app_revol_util",
    "sec_app_open_act_il",
    "sec_app_num_rev_accts",
    "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med",
    "sec_app_mths_since_last_major_derog",
)
JOINT_COLUMNS = (
    "annual_inc_joint",
    "dti_joint",
    "verification_status_joint",
    "revol_bal_joint",
)
SPARSE_BLOCKS = {
    "hardship": HARDSHIP_COLUMNS,
    "settlement": SETTLEMENT_COLUMNS,
    "sec_app": SEC_APP_COLUMNS,
    "joint": JOINT_COLUMNS,
}

# Sparse columns parsed as numbers, and as "Mon-YYYY" dates.
SPARSE_NUMERIC_COLUMNS = (
    "annual_inc_joint",
    "dti_joint",
    "hardship_amount",
    "hardship_dpd",
    "hardship_payoff_balance_amount",
    "hardship_last_payment_amount",
    "orig_projected_additional_accrued_interest",
    "deferral_term",
    "settlement_amount",
    "settlement_percentage",
    "settlement_term",
)
SPARSE_DATE_COLUMNS = (
    "sec_app_earliest_cr_line",
    "debt_settlement_flag_date",
    "settlement_date",
    "hardship_start_date",
    "hardship_end_date",
    "payment_plan_start_date",
)

# Known loan purposes (14).
PURPOSES = (
    "debt_consolidation",
    "credit_card",
    "home_improvement",
    "other",
    "major_purchase",
    "medical",
    "small_business",
    "car",
    "moving",
    "vacation",
    "house",
    "wedding",
    "renewable_energy",
    "educational",
)
# Two upper-case letters.  The source uses "$"; "\z" is used here so that a value
# ending in a newline is rejected (Java's "$" would also match before it).
STATE_PATTERN = r"^[A-Z]{2}\z"

# Resolved outcomes kept for labelling, and the one that counts as a default.
RESOLVED_STATUSES = ("Fully Paid", "Charged Off")
DEFAULT_STATUS = "Charged Off"

# Debt-to-income buckets: value < bound gets the label at the same position; values
# at or above the last bound get the last label; null gets the unknown label.
DTI_BOUNDS = (20, 40)
DTI_LABELS = ("Low", "Moderate", "High")
DTI_UNKNOWN = "Unknown"

# Dimensions of the bad-rate table.
NPL_DIMENSIONS = ("grade", "addr_state", "purpose", "vintage_year")

# Columns of the quality report.
NULL_CHECK_COLUMNS = (
    "is_default",
    "grade",
    "addr_state",
    "purpose",
    "vintage_year",
    "loan_age_months",
    "dti_bucket",
    "has_prior_delinquency",
)
DISTRIBUTION_COLUMNS = (
    "grade",
    "dti_bucket",
    "purpose",
    "vintage_year",
    "has_prior_delinquency",
)
# Percentage-point shift that flags drift.
DRIFT_THRESHOLD_PCT = 2.0

# Column in which the CSV reader keeps the text of rows with a wrong field count.
CORRUPT_COLUMN = "_corrupt_record"
#: The file a raw row was read from, where the reader was asked for it.
FILE_COLUMN = "_source_file"

# Rows shown by previews.
PREVIEW_ROWS = 10

# Raw columns that hold numbers, beside those that a cleaning step parses itself.
NUMERIC_TYPES = {
    "id": "bigint",
    "loan_amnt": "double",
    "funded_amnt": "double",
    "funded_amnt_inv": "double",
    "int_rate": "double",
    "installment": "double",
    "annual_inc": "double",
    "fico_range_low": "double",
    "fico_range_high": "double",
    "inq_last_6mths": "double",
    "mths_since_last_delinq": "double",
    "mths_since_last_record": "double",
    "open_acc": "double",
    "pub_rec": "double",
    "revol_bal": "double",
    "revol_util": "double",
    "total_acc": "double",
    "out_prncp": "double",
    "out_prncp_inv": "double",
    "total_pymnt": "double",
    "total_pymnt_inv": "double",
    "total_rec_prncp": "double",
    "total_rec_int": "double",
    "total_rec_late_fee": "double",
    "recoveries": "double",
    "collection_recovery_fee": "double",
    "last_pymnt_amnt": "double",
    "last_fico_range_high": "double",
    "last_fico_range_low": "double",
    "collections_12_mths_ex_med": "double",
    "acc_now_delinq": "double",
    "tot_coll_amt": "double",
    "tot_cur_bal": "double",
    "total_rev_hi_lim": "double",
    "acc_open_past_24mths": "double",
    "avg_cur_bal": "double",
    "bc_open_to_buy": "double",
    "bc_util": "double",
    "delinq_amnt": "double",
    "mort_acc": "double",
    "num_accts_ever_120_pd": "double",
    "pct_tl_nvr_dlq": "double",
    "pub_rec_bankruptcies": "double",
    "tax_liens": "double",
    "tot_hi_cred_lim": "double",
    "total_bal_ex_mort": "double",
    "total_bc_limit": "double",
}

# --- end of fixed values ------------------------------------------------------
