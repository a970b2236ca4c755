"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loanframe.sources import scratch_path

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application, so that
    the Python functions of the operators can be imported there.

    Spark's own file service carries the archive; executors need no copy of the
    repository on their disks.
    """
    sc = spark.sparkContext
    if getattr(sc, "_loanframe_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="loanframe-"), "loanframe_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(_PACKAGE)))
    sc.addPyFile(archive)
    sc._loanframe_shipped = True


def with_fields(df: DataFrame, *fields: StructField) -> StructType:
    """Schema of ``df`` with ``fields`` appended; fields of the same name (in any
    case) are replaced."""
    names = {f.name.lower() for f in fields}
    return StructType([f for f in df.schema.fields if f.name.lower() not in names] + list(fields))


def column(name: str) -> Column:
    """The column of that very name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, so that no column added beside it
    can clash with theirs."""
    return F.struct(*[column(c) for c in df.columns]).alias("row")


def unpacked(columns: Sequence[str], **values: Column) -> list[Column]:
    """The columns of ``row`` again, with those in ``values`` replaced."""
    return [values.get(c, F.col("row").getField(c)).alias(c) for c in columns]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of the table's files,
    never a recomputation of what made them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_remainder(name: str, modulus: int) -> Column:
    """``crc32(column as text) mod modulus``."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % modulus
