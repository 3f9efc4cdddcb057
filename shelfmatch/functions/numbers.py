"""Guarded arithmetic and small helpers shared by the column builders."""

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null, not an error, for a zero denominator."""
    return F.when(denominator != 0, numerator / denominator)


def text_or_null(column: Column) -> Column:
    """``regexp_extract`` gives '' where nothing matched."""
    return F.nullif(column, F.lit(""))


def decimal_comma(column: Column) -> Column:
    return F.replace(column, F.lit(","), F.lit(".")).try_cast("double")


def lookup(key: Column, table: dict, default: Column) -> Column:
    """Map a column through a small literal table. One expression per use of ``key``: nested CASE chains would grow
    with the product of their branches once the optimizer inlines them."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), default)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``; inside lambdas Spark does not share subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
