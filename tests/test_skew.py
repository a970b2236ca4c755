"""A customer holding a third of all orders: the test view's join is split by AQE.

Small inline tables are written to the scratch folder only to exercise the join;
the registered queries read the driver's tables.
"""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from loanframe.operators import npl_ratio_by_dimensions
from loanframe.plans import prepare_loans
from loanframe.sources import loan_view
from loanframe.sources import tpch_loans as lv

N = 30_000
AT_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


def _write_tables(spark, d):
    ts = F.make_timestamp_ntz
    orders = spark.range(N, numPartitions=8).select(
        F.col("id").alias("o_orderkey"),
        # customer 1 holds a third of all orders
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 97 + 2).cast("bigint").alias("o_custkey"),
        F.when(F.col("id") % 2 == 0, "F").otherwise("O").alias("o_orderstatus"),
        (F.col("id") * 1.5).alias("o_totalprice"),
        ts(F.lit(1996), (F.col("id") % 12 + 1).cast("int"), F.lit(5), F.lit(0), F.lit(0), F.lit(0)).alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    customer = spark.range(1, 100).select(
        F.col("id").alias("c_custkey"),
        (F.col("id") % 25).cast("int").alias("c_nationkey"),
        (F.col("id") * 10.0).alias("c_acctbal"),
        F.lit("BUILDING").alias("c_mktsegment"),
    )
    nation = spark.range(25).select(
        F.col("id").cast("int").alias("n_nationkey"), (F.col("id") % 5).cast("int").alias("n_regionkey")
    )
    lineitem = spark.range(N * 2).select(
        (F.col("id") % N).alias("l_orderkey"),
        F.when(F.col("id") % 5 == 0, "R").otherwise("N").alias("l_returnflag"),
        ts(F.lit(1997), F.lit(3), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("l_shipdate"),
    )
    for name, df in (("orders", orders), ("customer", customer), ("nation", nation), ("lineitem", lineitem)):
        df.write.mode("overwrite").parquet(f"{d}/{name}.parquet")


def test_hot_customer_is_split_and_rows_are_whole(spark, tmp_out):
    d = tmp_out("skew-tables")
    _write_tables(spark, d)
    saved = {k: spark.conf.get(k, None) for k in AT_SCALE}
    try:
        for k, v in AT_SCALE.items():
            spark.conf.set(k, v)
        view = loan_view(spark, d)
        rows = view.collect()
        buf = io.StringIO()
        with redirect_stdout(buf):
            view.explain()
        plan = buf.getvalue()
        assert len(rows) == N
        # customer 1 (nation 1, region 1: state "BB") keeps its third, less injected dirt
        assert sum(1 for r in rows if r.addr_state == "BB") > N // 4
        assert "SortMergeJoin(skew=true)" in plan
        ratio = npl_ratio_by_dimensions(
            prepare_loans(view, lv.DATE_COLUMNS, lv.NUMERIC_SPARSE, lv.DATE_SPARSE)
        ).collect()
        totals = {}
        for r in ratio:
            totals[r.dimension] = totals.get(r.dimension, 0) + r.total_count
        assert len(set(totals.values())) == 1
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
