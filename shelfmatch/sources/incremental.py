"""Batch loads that continue where the last one stopped."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remaining(todo: DataFrame, done: DataFrame, group="sub_cat") -> DataFrame:
    """Rows whose group has not been written yet. The done groups are reduced to one row each before the join."""
    return todo.join(done.select(group).distinct(), group, "left_anti")


def group_sizes(todo: DataFrame, group="sub_cat") -> DataFrame:
    return todo.groupBy(group).agg(F.count(F.lit(1)).alias("n_products"))
