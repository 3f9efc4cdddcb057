"""Positions and running totals over a whole table in order, without pulling it into one task.

The rows are range-partitioned and staged, so that every later read sees the same slices. The totals of the slices
(as many rows as there are slices) give each slice its start; within a slice a window does the rest.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.sources.staging import stage

SLICE_ROWS = 500_000


def running_totals(df: DataFrame, order: list, totals: dict[str, str], within: tuple = ()) -> DataFrame:
    """Add inclusive running sums in ``order``: ``{"new column": "column to sum"}``, restarted per ``within`` group; the
    whole sum comes as ``<new column>_all``.

    ``order`` should tell the rows apart (add a key as the last part): equal rows would share one slice.
    """
    df = stage(df, "unordered")  # read to count, to find the bounds of the slices and to fill them
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // SLICE_ROWS)
    sorting = [*within, *order]
    slices = stage(df.repartitionByRange(n, *sorting).withColumn("slice", F.spark_partition_id()), "slices")
    before = Window.partitionBy(*within).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*within)
    sums = slices.groupBy(*within, "slice").agg(*[F.sum(c).alias(f"{name}_slice") for name, c in totals.items()])
    starts = sums.select(
        *within, "slice",
        *[F.coalesce(F.sum(f"{name}_slice").over(before), F.lit(0)).alias(f"{name}_start") for name in totals],
        *[F.sum(f"{name}_slice").over(everything).alias(f"{name}_all") for name in totals],
    )
    if not within:
        starts = F.broadcast(starts)  # one row per slice, n at most
    inside = Window.partitionBy(*within, "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    added = {name: F.col(f"{name}_start") + F.sum(c).over(inside) for name, c in totals.items()}
    return slices.join(starts, [*within, "slice"]).withColumns(added).drop("slice", *[f"{name}_start" for name in totals])


def with_position(df: DataFrame, order: list, column="position") -> DataFrame:
    """Dense 0-based position of every row in ``order``, and the number of rows as ``<column>_all``."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, {column: "_one"})
    return counted.withColumn(column, F.col(column) - 1).drop("_one")
