"""Which shop is cheaper on matched pairs (columns price_a, price_b, own_brand_a)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions.numbers import ratio

GROUPS = {"Overall": None, "Own Brand": "own_brand_a"}


def correct_pairs(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("label") == 1)


def predicted_pairs(pairs: DataFrame, threshold=K.MATCH_THRESHOLD) -> DataFrame:
    return pairs.where(F.col("score") > threshold)


def with_price_diffs(pairs: DataFrame) -> DataFrame:
    """Price of shop b minus price of shop a, also relative to the higher one."""
    diff = F.col("price_b") - F.col("price_a")
    return pairs.withColumns({
        "abs_price_diff": diff,
        "rel_price_diff": ratio(diff, F.greatest(F.col("price_a"), F.col("price_b"))),
    })


def _wins(member):
    a, b = F.col("price_a"), F.col("price_b")
    return {
        "cheaper_a": F.count_if(member & (a < b)),
        "equal": F.count_if(member & (a == b)),
        "cheaper_b": F.count_if(member & (b < a)),
    }


def _member(column):
    return F.lit(True) if column is None else F.coalesce(F.col(column), F.lit(False))


def _report(pairs: DataFrame, columns) -> DataFrame:
    """One row per group from one aggregate: own brand is part of overall, so the groups are column sets, not keys."""
    names = None
    cells, rows = [], []
    for group, column in GROUPS.items():
        built = columns(_member(column))
        names = list(built)
        tags = [f"{name}_{len(rows)}" for name in names]
        cells += [value.alias(tag) for tag, value in zip(tags, built.values())]
        rows.append([F.lit(group), *[F.col(t) for t in tags]])
    flat = [column for row in rows for column in row]
    return pairs.agg(*cells).select(F.stack(F.lit(len(rows)), *flat).alias("scope", *names))


def wins_table(pairs: DataFrame) -> DataFrame:
    """How often each shop is cheaper, outliers included."""
    return _report(pairs, _wins)


def price_comparison(pairs: DataFrame) -> DataFrame:
    """Wins, then mean relative difference and basket totals without outliers (promotions), overall and own brand."""
    def columns(member):
        usual = member & (F.abs(F.col("rel_price_diff")) < K.OUTLIER_SHARE)
        return {
            **_wins(member),
            "n_pairs": F.count_if(usual),
            "mean_rel_diff": F.avg(F.when(usual, F.col("rel_price_diff"))),
            "total_a": F.coalesce(F.sum(F.when(usual, F.col("price_a"))), F.lit(0.0)),
            "total_b": F.coalesce(F.sum(F.when(usual, F.col("price_b"))), F.lit(0.0)),
        }

    report = _report(with_price_diffs(pairs), columns)
    mean = F.col("mean_rel_diff")
    share = F.format_string("%.1f%%", F.abs(mean) * 100)
    cheaper = F.when(mean > 0, "a").when(mean <= 0, "b")  # null without pairs, and so is the sentence
    verdict = F.concat(F.lit("shop "), cheaper, F.lit(" is "), share, F.lit(" cheaper on average"))
    return report.withColumn("verdict", verdict)


def wins_offsets(wins: DataFrame) -> DataFrame:
    """Left ends of the three bars of a diverging chart, centred on the equal pairs."""
    left_equal = -F.col("equal") / 2
    return wins.select(
        "scope", left_equal.alias("left_equal"), (left_equal - F.col("cheaper_a")).alias("left_a"),
        (F.col("equal") / 2).alias("left_b"),
    )
