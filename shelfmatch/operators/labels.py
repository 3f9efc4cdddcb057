"""Label sample, label updates and the review table."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.operators.ordered import with_position
from shelfmatch.sources.staging import stage

STRATA = ("high", "middle", "low")


def score_strata(scored: DataFrame, key: list[str]) -> DataFrame:
    """Thirds by position in descending score order (ties by key)."""
    ranked = with_position(scored, [F.desc("score"), *key])
    n = F.col("position_all")
    third, two_thirds = F.floor(n / 3), F.floor(2 * n / 3)
    stratum = F.when(F.col("position") < third, STRATA[0]).when(F.col("position") < two_thirds, STRATA[1]).otherwise(STRATA[2])
    return ranked.withColumn("stratum", stratum).drop("position_all")


def stratified_sample(scored: DataFrame, key: list[str], draws=K.SAMPLE_DRAWS, seed=K.SAMPLE_SEED) -> DataFrame:
    """Exactly that many rows per third, without replacement, repeatable: the lowest md5 of key and seed.

    Each draw is a top-k over all partitions, so no stratum is ever gathered.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed)))
    strata = stage(score_strata(scored, key).withColumn("draw_hash", F.md5(text.cast("binary"))), "strata")  # read per third
    parts = [
        strata.where(F.col("stratum") == name).orderBy("draw_hash", *key).limit(k) for name, k in zip(STRATA, draws)
    ]
    return reduce(DataFrame.unionByName, parts)


def attach_labels(pairs: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """Labels given so far, by pair key; pairs without one stay."""
    return pairs.join(labels.select(*key, "label"), key, "left")


def upsert_labels(labels: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """The latest label per pair. ``updates`` carry an increasing ``version`` >= 1; of equal versions the greater row
    wins. Partial maxima before the shuffle."""
    both = labels.withColumn("version", F.lit(0).cast("bigint")).unionByName(updates.select(*labels.columns, "version"))
    others = [c for c in labels.columns if c not in key]
    latest = both.groupBy(*key).agg(F.max(F.struct("version", *others)).alias("latest"))
    return latest.select(*[c if c in key else F.col(f"latest.{c}") for c in labels.columns])


def review_rows(sample: DataFrame, pairs: DataFrame, key: list[str]) -> DataFrame:
    """The drawn pairs with their sub-scores, quantities and prices, numbered from 0 by draw: high, middle, low third.

    The window sees the sample alone, which is as long as the draws add up to.
    """
    turn = F.array_position(F.array(*[F.lit(s) for s in STRATA]), F.col("stratum"))
    place = F.row_number().over(Window.orderBy(turn, "draw_hash", *key)) - 1
    drawn = sample.select(*key, "stratum", place.alias("draw"))
    return pairs.join(drawn, key)
