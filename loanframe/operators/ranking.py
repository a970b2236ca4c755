"""Ranks over any number of rows, computed in many tasks.

A window over one group sorts that whole group in one task.  Here the rows are sorted
into ranges over all tasks instead; a row's rank is its place in its range plus the
number of rows of its group in the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanframe.functions import named
from loanframe.sources.files import scratch_table

# monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


def ranked(
    df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """``df`` with ``name``: 1, 2, 3... in the order ``order`` among the rows of equal
    ``within`` (null counts as a value).

    The rows are range-partitioned by group and order, so that a group of any size is
    spread over tasks, and written sorted with their running number to the shared folder
    (a second evaluation could deal the ranges otherwise).  The count of each group in
    each range, a table of as many rows as there are ranges and groups, gives the ranks
    at which ranges begin.  Rows that ``order`` cannot tell apart get consecutive ranks
    in any order.
    """
    at, span = _free(df, "at"), _free(df, "span")
    keys = [named(c).asc_nulls_first() for c in within] + list(order)
    placed = scratch_table(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(at, F.monotonically_increasing_id()),
        "ranges",
    )
    placed = placed.withColumn(span, F.shiftright(at, _ROW_BITS))
    sizes = placed.groupBy(*[named(c) for c in within], span).agg(
        F.min(at).alias("first_at"), F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy(*[named(c) for c in within]).orderBy(span)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[named(c) for c in within],
        named(span),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_at") + 1).alias("start"),
    )
    # Written, so that its size is known when the join is planned: small, it is sent to
    # the tasks that read the rows, and the rows are not shuffled again.
    starts = scratch_table(starts, "range-starts")
    same = [placed[c].eqNullSafe(starts[c]) for c in within] + [placed[span] == starts[span]]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return placed.join(starts, on).select(
        *[placed[c] for c in df.columns if c != name], (placed[at] + starts["start"]).alias(name)
    )


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
