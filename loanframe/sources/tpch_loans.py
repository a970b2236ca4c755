"""A loan-shaped raw table derived from the TPC-H-style test tables.

The test data has no loan table, so one is derived from ``orders``, ``customer``,
``nation`` and ``lineitem``: one raw loan per order, every loan column as text,
with malformed, null, misaligned and out-of-domain values injected by key.  The
rules are fixed so the same rows can be rebuilt in SQL by another engine.

Plan: ``lineitem`` is aggregated per order first (partial aggregate, then one
shuffle by order key), so the join to orders moves one row per order, not per line.
``orders`` joins ``customer`` on the customer key (sort-merge at scale; AQE splits a
customer that holds a large share of orders), and ``nation`` (25 rows) is joined by
Spark's size-checked broadcast.  Only the columns used are read from each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: the injection rules of the test fixture (key divisors and values).
PURPOSE_DOMAIN = ("automobile", "building", "furniture", "household", "machinery")
DATE_COLUMNS = ("issue_d", "last_pymnt_d")
NUMERIC_SPARSE = ("hardship_amount", "settlement_amount", "annual_inc_joint")
DATE_SPARSE = ("hardship_start_date", "settlement_date", "sec_app_earliest_cr_line")
SPARSE_BLOCKS = {
    "hardship": ("hardship_amount", "hardship_start_date"),
    "settlement": ("settlement_amount", "settlement_date"),
    "sec_app": ("sec_app_earliest_cr_line",),
    "joint": ("annual_inc_joint",),
}
RAW_COLUMNS = (
    "id",
    "member_id",
    "grade",
    "addr_state",
    "purpose",
    "loan_status",
    "issue_d",
    "last_pymnt_d",
    "term",
    "dti",
    "delinq_2yrs",
    "hardship_amount",
    "hardship_start_date",
    "settlement_amount",
    "settlement_date",
    "sec_app_earliest_cr_line",
    "annual_inc_joint",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(k: int) -> Column:
    return F.col("o_orderkey") % F.lit(k) == 0


def _month_year(c: str) -> Column:
    return F.date_format(F.col(c), "MMM-yyyy")


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw loan table (all text columns except the bigint ``id``)."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority",
    )
    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    lines = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey"))
        .agg(
            F.max("l_shipdate").alias("last_ship"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_ret"),
        )
    )
    base = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    null = F.lit(None).cast("string")
    grade_index = F.substring(F.col("o_orderpriority"), 1, 1).cast("int")
    return base.select(
        F.col("o_orderkey").alias("id"),
        null.alias("member_id"),
        F.when(_every(401), null)
        .otherwise(F.substring(F.lit("ABCDE"), grade_index, F.lit(1)))
        .alias("grade"),
        F.when(_every(211), F.lit("941xx"))
        .when(_every(223), F.lit("ca"))
        .when(_every(227), null)
        .otherwise(
            F.concat(
                F.chr(F.lit(65) + F.col("n_nationkey")),
                F.chr(F.lit(65) + F.col("n_regionkey")),
            )
        )
        .alias("addr_state"),
        F.when(_every(307), F.lit("bogus"))
        .when(_every(311), null)
        .otherwise(F.lower("c_mktsegment"))
        .alias("purpose"),
        F.when(_every(409), null)
        .when(F.col("o_orderstatus") == "F", F.lit("Fully Paid"))
        .when(F.col("o_orderstatus") == "O", F.lit("Charged Off"))
        .otherwise(F.lit("Current"))
        .alias("loan_status"),
        F.when(_every(97), F.lit("not a date"))
        .when(_every(101), F.lit("Foo-2015"))
        .when(_every(89), null)
        .otherwise(F.concat(F.lit(" "), _month_year("o_orderdate")))
        .alias("issue_d"),
        F.when(_every(103), F.lit("")).otherwise(_month_year("last_ship")).alias("last_pymnt_d"),
        F.when(_every(83), F.lit("n/a"))
        .when(_every(2), F.lit(" 36 months"))
        .otherwise(F.lit(" 60 months"))
        .alias("term"),
        F.when(_every(79), F.lit("n/a"))
        .otherwise((F.col("c_acctbal") / F.lit(200)).cast("string"))
        .alias("dti"),
        F.when(_every(73), null)
        .when(_every(71), F.lit("-1"))
        .otherwise(F.col("n_ret").cast("string"))
        .alias("delinq_2yrs"),
        F.when(_every(253), F.lit("bad"))
        .when(_every(11), (F.col("o_totalprice") / F.lit(10)).cast("string"))
        .alias("hardship_amount"),
        F.when(_every(253), F.lit("bad"))
        .when(_every(11), _month_year("o_orderdate"))
        .alias("hardship_start_date"),
        F.when(_every(23), (F.col("o_totalprice") / F.lit(4)).cast("string")).alias(
            "settlement_amount"
        ),
        F.when(_every(23), _month_year("last_ship")).alias("settlement_date"),
        F.when(_every(19), _month_year("o_orderdate")).alias("sec_app_earliest_cr_line"),
        F.when(_every(19), F.col("o_totalprice").cast("string")).alias("annual_inc_joint"),
    )
