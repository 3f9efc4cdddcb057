"""Cut lineage by writing a table to the shared checkpoint folder.

A staged table is read by several branches of a plan, or must keep a partition layout that a re-run could change.
It lives in the folder the session names in ``spark.checkpoint.dir``, so a lost executor costs a re-read only.
"""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_KEY = "spark.checkpoint.dir"
BROADCAST_BYTES = 32_000_000


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="shelfmatch-")  # driver and executors are one process, as in tests
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/shelfmatch/{spark.sparkContext.applicationId}"


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables; results that still read them must be written before."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has staged."""
    drop(spark, [application_folder(spark)])


_GIVEN: dict[str, list[str]] = {}  # paths by application


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses, grouped by application so that it can be cleared later."""
    path = f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def mark(spark: SparkSession) -> int:
    """A point in time for ``since``."""
    return len(_GIVEN.get(spark.sparkContext.applicationId, []))


def since(spark: SparkSession, begun: int) -> list[str]:
    """The paths given out since a mark."""
    return _GIVEN.get(spark.sparkContext.applicationId, [])[begun:]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(staged: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring a staged table; beyond ``max_bytes`` the join shuffles (AQE splits skew)."""

    def width(field):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 16
        return F.coalesce(F.size(column), F.lit(0)) * 16 + 16 if isinstance(field.dataType, T.ArrayType) else F.lit(16)

    held = sum([width(f) for f in staged.schema], F.lit(0)).cast("double")
    return F.broadcast(staged) if (staged.agg(F.sum(held)).first()[0] or 0) <= max_bytes else staged
