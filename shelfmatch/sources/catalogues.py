"""Reading and writing catalogues, product vectors and labels."""

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _headers(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below ``path``, those of one header line together. Only first lines leave the scan; empty lines before
    them do not count, as for the CSV reader."""
    place = {"file": F.col("_metadata.file_path"), "begin": F.col("_metadata.file_block_start"), "at": F.monotonically_increasing_id()}
    lines = spark.read.text(path).withColumns(place).where((F.col("begin") == 0) & (F.trim("value") != ""))
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy(F.col("files")[0])
    return [[re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in row["files"]] for row in groups.collect()]  # names, no patterns


def read_csv(spark: SparkSession, path: str, columns: str, strict=False, line_breaks=False) -> DataFrame:
    """CSV with a header, read by name into a declared schema, in any order of the columns in a file.

    Each file is read by its own header: if there are several files, a first pass over their lines groups them by it.
    Columns that a file lacks are an error if ``strict``, else null; others that it has are left out. ``strict`` also
    fails on a malformed row or value, else the bad value is null. ``line_breaks`` allows them in quoted fields, but then
    a file is read by one task, as it cannot be split. A path without lines gives no rows.
    """
    options = {"header": True, "multiLine": line_breaks, "escape": '"', "mode": "FAILFAST" if strict else "PERMISSIVE"}
    wanted = T.StructType.fromDDL(columns)
    kinds = {f.name: f.dataType for f in wanted}

    def read(files):
        header = spark.read.options(**options).csv(files).columns  # of the first line
        missing = [f.name for f in wanted if f.name not in header]
        if strict and missing:
            raise ValueError(f"{files if isinstance(files, str) else files[0]} lacks the columns {', '.join(missing)}")
        stored = T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in header])
        found = spark.read.options(**options).schema(stored).csv(files, enforceSchema=not strict)
        return found.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in missing else F.col(f"`{f.name}`") for f in wanted])

    groups = _headers(spark, path) if len(spark.read.text(path).inputFiles()) > 1 else []
    if len(groups) < 2:
        return read(path)  # also finds columns that stand in the names of folders
    return reduce(DataFrame.unionByName, [read(files) for files in groups])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export, replacing what is there; lists and maps are written as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    columns = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema]
    df.select(*columns).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet, replacing what is there; ``by`` (the shop) makes one folder per value, so a read of one shop prunes."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows; each write is its own set of files, so no header line can end up among the rows."""
    df.write.mode("append").parquet(path)


def read_shop(spark: SparkSession, path: str, shop) -> DataFrame:
    return spark.read.parquet(path).where(F.col("shop") == shop)


def write_vectors(products: DataFrame, path: str) -> None:
    """Vector store, one folder per shop."""
    write_table(products.select("shop", "product_id", "embedding"), path, by="shop")


def read_vectors(spark: SparkSession, path: str, shop) -> DataFrame:
    return read_shop(spark, path, shop).select("product_id", "embedding")
