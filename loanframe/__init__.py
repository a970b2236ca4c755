"""loanframe: loan-portfolio cleaning, labelling, bad-rate metrics and data-quality
checks written as Spark DataFrame transformations.

Every operator takes and returns a ``DataFrame`` (or a small metric ``DataFrame``);
column names and rule tables are parameters whose defaults live in
:mod:`loanframe.rules`.  Nothing in the core collects rows to the driver; the only
driver reads are the one-row results behind the raising checks.

    import loanframe as lf
    loans = lf.plans.prepare_loans(lf.sources.read_raw_csv(spark, "loans.csv.gz"))
    lf.operators.npl_ratio_by_dimensions(loans).show()
"""

from loanframe import functions, operators, plans, rules, sources

__version__ = "0.1.0"

__all__ = ["functions", "operators", "plans", "rules", "sources", ]
