"""File sources and sinks.

Raw text is read as all-string columns from the header (no inference pass over
the data); typing is the job of the cleaning operators, which turn malformed text
into nulls instead of failing.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loanframe import rules
from loanframe.functions import named
from loanframe.sources.releases import (
    discard_run,
    file_system,
    latest_release,
    publish_run,
    stage_run,
)


def string_schema(columns: Sequence[str]) -> StructType:
    """All-string schema for the raw columns."""
    return StructType([StructField(c, StringType(), True) for c in columns])


# Extensions of compressed text that cannot be split: one file is one task.
_UNSPLITTABLE = (".gz", ".zst", ".lz4", ".snappy", ".deflate", ".xz")


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file under ``path`` (only its header is read)."""
    return spark.read.option("header", True).csv(path).columns


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    partitions: int | None = None,
    corrupt_column: str | None = rules.CORRUPT_COLUMN,
    file_column: str | None = None,
) -> DataFrame:
    """Read raw loan CSV with a header, every column as string.

    Columns are found by their header name.  Each of several paths may have its own
    column order; with ``columns`` the result is that subset, in that order, and a
    column that a header lacks is an error; without, all headers must name the same
    columns.  Files within one path (a folder, a glob) must share one header: Spark
    compares every file's header with the schema and fails on another one, so values
    never land under another column's name.

    ``PERMISSIVE`` keeps rows with a wrong field count (missing fields become null,
    extra ones are dropped); those are the misaligned rows that
    :func:`loanframe.operators.drop_shifted_rows` removes.  Their raw text is kept in
    ``corrupt_column`` (null on other rows; ``None`` leaves the column out), which
    :func:`loanframe.operators.batch_stats` counts, the published batch job keeps
    (:func:`loanframe.plans.publish_batch`) and the cleaning drops.  With ``file_column``
    (``rules.FILE_COLUMN`` for that job) every row also names its file.

    Compressed files that cannot be split (gzip and the like) arrive as one partition
    each and are spread over ``partitions`` (default: the session's shuffle
    partitions) before the per-row work; other input is repartitioned only when
    ``partitions`` is given.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        raise ValueError("read_raw_csv: no path given")
    parts, first = [], None
    for one in paths:
        header = _header(spark, one)
        wanted = list(columns) if columns is not None else first or header
        first = wanted
        missing = [c for c in wanted if c not in header]
        extra = [c for c in header if c not in wanted] if columns is None else []
        if missing or extra:
            raise ValueError(
                f"read_raw_csv: the header of {one} lacks {missing} and adds {extra}"
                if extra
                else f"read_raw_csv: the header of {one} lacks {missing}"
            )
        for taken in (corrupt_column, file_column):
            if taken and taken in header:
                raise ValueError(f"read_raw_csv: {one} has a column named {taken}")
        schema = string_schema(header)
        reader = (
            spark.read.option("header", True)
            .option("mode", "PERMISSIVE")
            .option("multiLine", False)
            .option("enforceSchema", False)
        )
        if corrupt_column:
            schema = schema.add(corrupt_column, StringType(), True)
            # A parser that skips columns does not see how many fields a line has.
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
        df = reader.schema(schema).csv(one)
        spread = partitions
        if spread is None and any(f.lower().endswith(_UNSPLITTABLE) for f in df.inputFiles()):
            spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Spark refuses queries of raw files that use the corrupt column alone, so it is
        # read together with another one; the condition always holds.
        read = F.coalesce(F.length(named(header[0])), F.lit(0)) >= 0
        added = [F.when(read, F.col(corrupt_column)).alias(corrupt_column)] if corrupt_column else []
        added += [F.col("_metadata.file_path").alias(file_column)] if file_column else []
        df = df.select(*[named(c) for c in wanted], *added)
        parts.append(df.repartition(spread) if spread else df)
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def write_csv(df: DataFrame, path: str) -> str:
    """Write text columns as CSV with a header, keeping leading and trailing
    spaces (the raw form :func:`read_raw_csv` reads)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_checkpoint(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = None
) -> str:
    """Overwrite the Parquet checkpoint at ``path`` (one kept at a time) (S3).

    The written table cuts the lineage: downstream jobs read it back with
    :func:`read_checkpoint` instead of recomputing the cleaning chain, and a lost
    executor only costs the re-read of its Parquet splits.

    Unpartitioned, the write is map-only (no shuffle).  With ``partition_by`` the
    rows are first rebalanced on those columns (``REBALANCE`` hint): otherwise every
    input split would write one small file per partition value, and AQE sizes the
    rebalanced partitions, splitting a value that holds a large share of the rows
    over several tasks.  (The split needs AQE, Spark's default; without it the
    rebalance is a plain hash repartition on those columns.)
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Read the Parquet checkpoint (S4); filters and projections reach the scan."""
    return spark.read.parquet(path)


def write_table(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    as_table: bool = False,
    path: str | None = None,
) -> str:
    """Overwrite a curated output, at a path or as a catalog table (S5); a table's files
    lie in the warehouse, or with ``path`` there."""
    writer = df.write.mode("overwrite").format(fmt)
    if as_table:
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(target)
    else:
        writer.save(target)
    return target


SNAPSHOT_SCHEMA = "column string, value string, row_count bigint, pct double"


def _is_plain_baseline(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` itself is a finished Parquet table: how baselines were kept
    before they had generations."""
    fs, at = file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(at)


def load_baseline(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored snapshot ``(column, value, row_count, pct)``: the newest generation that
    was saved to its end, or ``None`` when there is none yet (S6).  What a failed save left
    is not seen."""
    newest = latest_release(spark, path)
    if newest is not None:
        return spark.read.schema(SNAPSHOT_SCHEMA).parquet(newest.path("snapshot"))
    if _is_plain_baseline(spark, path):
        return spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)
    return None


#: A JSON baseline holds one number per value of a few columns.
JSON_BASELINE_BYTES = 64 << 20


def load_json_baseline(spark: SparkSession, path: str) -> DataFrame | None:
    """A baseline kept as one JSON object ``{column: {value: pct}}`` (the form the
    source job stored), as snapshot rows ``(column, value, row_count, pct)``; ``None``
    when the file is absent.  A damaged or empty file is a ``ValueError``, as is one
    over ``JSON_BASELINE_BYTES`` (it is parsed as one value).

    Keys were Python ``str(value)``: ``"None"`` becomes null and ``"True"`` /
    ``"False"`` become ``"true"`` / ``"false"``, the text Spark gives those values,
    so the rows join with :func:`loanframe.operators.distribution_snapshot`.
    ``row_count`` is null (the JSON form has none).
    """
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return None
    if fs.getFileStatus(at).getLen() > JSON_BASELINE_BYTES:
        raise ValueError(f"load_json_baseline: {path} is larger than {JSON_BASELINE_BYTES} bytes")
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string,map<string,double>>", {"mode": "FAILFAST"})
    pairs = text.select(F.explode(parsed).alias("column", "values")).select(
        "column", F.explode("values").alias("key", "pct")
    )
    value = (
        F.when(F.col("key") == "None", F.lit(None).cast("string"))
        .when(F.col("key") == "True", F.lit("true"))
        .when(F.col("key") == "False", F.lit("false"))
        .otherwise(F.col("key"))
    )
    rows = pairs.select(
        "column",
        value.alias("value"),
        F.lit(None).cast("bigint").alias("row_count"),
        "pct",
    )
    try:
        usable = rows.agg(F.count(F.lit(1)), F.count("pct")).first()
    except (PySparkException, Py4JJavaError) as e:
        raise ValueError(f"load_json_baseline: {path} is not a JSON object of shares") from e
    if usable[0] == 0 or usable[1] < usable[0]:
        raise ValueError(f"load_json_baseline: {path} holds no usable shares")
    return rows


def save_baseline(snapshot: DataFrame, path: str, refresh: bool = False) -> str:
    """Save a snapshot as the baseline.

    The baseline is written once and then kept; ``refresh=True`` adds a newer generation,
    and the older ones stay readable (:func:`loanframe.sources.all_releases`).  A generation
    counts from the moment its manifest appears, so a save that dies at any point leaves
    the baseline as it was.  Of two first saves at once one is kept and the other one is a
    ``ValueError``.  So is a snapshot without rows: it would flag every value of every
    later run.
    """
    spark = snapshot.sparkSession
    if not refresh and load_baseline(spark, path) is not None:
        raise ValueError(f"save_baseline: {path} already holds a baseline")
    run = stage_run(path)
    snapshot.select("column", "value", "row_count", "pct").write.parquet(f"{run}/snapshot")
    rows = spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{run}/snapshot").count()
    if rows == 0:
        discard_run(spark, run)
        raise ValueError("save_baseline: the snapshot has no rows")
    publish_run(spark, run, {"snapshot": "snapshot"}, {"rows": rows}, first_only=not refresh)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none and runs in local mode (tests) is a fresh
    local folder created and registered as the checkpoint directory; on a cluster
    a machine-local folder would be wrong, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a shared folder for the "
                "checkpoint and outputs"
            )
        configured = tempfile.mkdtemp(prefix="loanframe-ckpt-")
        spark.sparkContext.setCheckpointDir(configured)
        configured = spark.sparkContext.getCheckpointDir() or configured
    return configured


def _scratch_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/loanframe/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under :func:`shared_dir` for one run's output."""
    return f"{_scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new scratch table and read back: its lineage ends there, and
    its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this application.  Call it when no result that
    reads one is needed any more, such as after a job's outputs are written."""
    fs, at = file_system(spark, _scratch_dir(spark))
    fs.delete(at, True)


__all__ = [
    "load_baseline",
    "load_json_baseline",
    "remove_scratch",
    "read_checkpoint",
    "read_raw_csv",
    "save_baseline",
    "scratch_path",
    "scratch_table",
    "shared_dir",
    "string_schema",
    "write_checkpoint",
    "write_csv",
    "write_table",
]
