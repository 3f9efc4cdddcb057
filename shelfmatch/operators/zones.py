"""Zone maps of large blocks: rows in ranges of quantity, name length and price, and the pairs of ranges worth joining.

A zone is a box of powers of a fixed step, so a row finds its zone alone. The map of a zone holds the least and greatest
values of its rows. From two maps follows the best score that any pair of their rows can have; pairs of zones below the
threshold are never joined.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions import similarity

NUMBERS = ("quantity", "price", "name_length", "n_tokens")
FINE_ROWS = 100_000  # rows of one side from which zones are narrow


def zone(n_rows: Column) -> Column:
    """The zone of a row in a block whose larger side has so many rows: wide boxes of quantity, name length and tokens, as a row
    is repeated for each zone it meets; in blocks of ``FINE_ROWS`` narrower ones. Values that are not above
    zero have their own."""

    def step(column, per_octave):
        value = F.col(column)
        return F.when(value > 0, F.floor(F.log2(value) * per_octave).cast("string")).otherwise(F.lit("none"))

    wide = F.concat_ws("/", step("quantity", 1), step("name_length", 2), step("n_tokens", 1), F.col("price") > 0)
    narrow = F.concat_ws("/", step("quantity", 2), step("name_length", 3), step("n_tokens", 1), F.col("price") > 0)
    return F.when(n_rows >= FINE_ROWS, narrow).otherwise(wide)


def zone_maps(rows: DataFrame) -> DataFrame:
    """(block_key, side, zone, n, least and greatest value of each number)."""
    ends = [f(c).alias(f"{c}_{name}") for c in NUMBERS for name, f in (("low", F.min), ("high", F.max))]
    return rows.groupBy("block_key", "side", "zone").agg(F.count(F.lit(1)).alias("n"), *ends)


def _closest(column: str) -> tuple[Column, Column, Column]:
    """(whether the ranges of both sides share a value, the greatest value of the lower range, the least of the other)."""
    low_a, high_a, low_b, high_b = (F.col(f"{column}_{end}_{side}").cast("double") for side in "ab" for end in ("low", "high"))
    shared = (low_a <= high_b) & (low_b <= high_a)
    return shared, F.least(high_a, high_b), F.greatest(low_a, low_b)


def best_score() -> Column:
    """No pair of rows of the two zones scores higher. Each part takes the values that are closest to each other; where a
    value is not above zero, the quantity and price parts are not bounded and count as endless."""

    def relative(column, power):
        shared, small, large = _closest(column)
        positive = F.least(F.col(f"{column}_low_a"), F.col(f"{column}_low_b")) > 0
        return F.when(~positive | positive.isNull(), F.lit(float("inf"))).when(shared, F.lit(1.0)).otherwise(F.pow(small / large, F.lit(power)))

    shared, small, large = _closest("name_length")
    fuzz = F.when(shared, F.lit(1.0)).otherwise(2 * small / (small + large))
    shared, small, large = _closest("n_tokens")
    nested = F.when(shared, F.lit(1.0)).otherwise(small / large)
    quantity, price = relative("quantity", 2.0), relative("price", 1.0)
    endless = (quantity == float("inf")) | (price == float("inf"))
    return F.when(endless, F.lit(float("inf"))).otherwise(similarity.weighted_score(F.lit(1.0), fuzz, nested, quantity, price))


def zone_pairs(maps: DataFrame, least_score: float) -> DataFrame:
    """(block_key, zone_a, zone_b, n_a, n_b) of the pairs of zones in which a pair of rows may score above ``least_score``."""

    def of(side):
        own = maps.where(F.col("side") == side).drop("side")
        return own.withColumnsRenamed({c: f"{c}_{side}" for c in own.columns if c != "block_key"})

    return of("a").join(of("b"), "block_key").where(best_score() > least_score).select("block_key", "zone_a", "zone_b", "n_a", "n_b")
