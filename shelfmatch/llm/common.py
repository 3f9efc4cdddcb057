"""Small helpers that the operators share."""

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 2_000_000  # text that a Python task holds in numpy form at a time
HEAVY = 4096  # a key of more than this part of all rows is heavy, so fewer keys than this are


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession, megabytes: int = 4, rows: int = 1000) -> None:
    """What a task holds of whole texts at a time, in the JVM and again in Python: rows are written in groups of 16 MB
    and go to Python in batches. Session settings, as they act when a result is read or written, which need not be here."""
    spark.conf.set("parquet.block.size", str(16 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add under the same names (its own values win)."""
    drop = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in drop])


def join_counted(rows: DataFrame, groups: DataFrame, key: list[str], total: int) -> DataFrame:
    """``rows`` joined with ``groups``, which has one row per key (never null) and the number ``n`` of its rows among
    all ``total``; ``n`` is left out. Both are staged, as they are read more than once.

    Heavy keys, fewer than ``HEAVY``, reach their rows by broadcast; only the rows of the others are shuffled. So no
    task gets more than a small part of all rows by one key.
    """
    heavy = F.col("n") * HEAVY > total
    near, far = F.broadcast(groups.where(heavy).drop("n")), groups.where(~heavy).drop("n")
    others = rows.join(near.select(*key), key, "left_anti")
    return rows.join(near, key).unionByName(others.join(far, key))


def hash_sample(rows: DataFrame, key: str, value: str, total: int, most: int) -> DataFrame:
    """(h, value): the ``most`` keys with the least hashes (fewer, if many of the ``total`` rows share a key), with the
    least value of each, in that order.

    Only rows with a hash so low that about twice as many keys as wanted have one are grouped and sorted. So what
    reaches the driver does not grow with the rows or the tasks; a plain top-k sends ``most`` rows of every task.
    """
    bound = -(1 << 63) + ((1 << 64) - 1) * min(total, 2 * most) // max(1, total)
    low = rows.select(F.xxhash64(quoted(key)).alias("h"), quoted(value).alias(value)).where(F.col("h") <= bound)
    return low.groupBy("h").agg(F.min(quoted(value)).alias(value)).orderBy("h").limit(most)


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does the same to texts of ASCII only, and much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def map_rows(df: DataFrame, run, added: T.StructType) -> DataFrame:
    """``df`` with the columns that ``run`` appends to its Arrow batches; any column names pass (``mapInArrow`` alone
    cannot read names with dots)."""
    names = [*df.columns, *added.names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    fresh = T.StructType([T.StructField(f"c{i + len(df.columns)}", f.dataType) for i, f in enumerate(added)])
    return plain.mapInArrow(run, T.StructType([*plain.schema, *fresh])).toDF(*names)


def with_columns(batch: pa.RecordBatch, columns: list) -> pa.RecordBatch:
    """``batch`` and more columns, as ``map_rows`` expects them."""
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], [f"c{i}" for i in range(batch.num_columns + len(columns))])


def text_blocks(batches: Iterable[pa.RecordBatch], text: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of each (column ``text``) hold at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
