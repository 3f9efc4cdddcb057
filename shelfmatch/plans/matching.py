"""Match two catalogues end to end: corpus statistics, blocks, candidates, scores, best match per product."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import text
from shelfmatch.operators import cleaning, matching, prices
from shelfmatch.plans.views import view
from shelfmatch.sources import catalogues as files
from shelfmatch.sources.staging import stage


def with_sides(catalogue: DataFrame, left=0, right=1) -> DataFrame:
    """The rows of two shops as side a and side b, with the text to encode."""
    return catalogue.where(F.col("shop").isin(left, right)).select(
        F.when(F.col("shop") == left, "a").otherwise("b").alias("side"),
        "product_id", "href", "name_only", "own_brand", "quantity", "price",
        text.product_text(*(F.col(c) for c in ("name_only", "quantity", "unit", "ingredients"))).alias("product_text"),
    )


def listing_sides(spark: SparkSession, folder: str) -> DataFrame:
    return with_sides(view(spark, folder, "listing"))


def scored_pairs(catalogues: matching.Catalogues, threshold: float | None = K.PAIR_THRESHOLD) -> DataFrame:
    """Scored pairs of profiles; the threshold also prunes the work, and so does it if only the best pairs are asked for."""
    return matching.score_pairs(catalogues.profiles, threshold, catalogues.best_only and threshold is not None)


def best_of(catalogues: matching.Catalogues, threshold: float = K.PAIR_THRESHOLD) -> DataFrame:
    """The best match above the threshold for each product of side a."""
    pairs = scored_pairs(catalogues._replace(best_only=True), threshold)
    return matching.best_matches(pairs, catalogues.members, catalogues.profiles)


def match(products: DataFrame, threshold: float = K.PAIR_THRESHOLD, **options) -> DataFrame:
    """From products to best matches; the options are those of ``prepare``."""
    return best_of(matching.prepare(products, **options), threshold)


def predicted(products: DataFrame, **options) -> DataFrame:
    """The best matches that are predicted to be right: no pair at or below that threshold can be one, so the threshold also
    prunes the work. A higher best pair is the best one under either threshold."""
    threshold = max(K.PAIR_THRESHOLD, K.MATCH_THRESHOLD)
    return prices.predicted_pairs(match(products, threshold, **options))


def staged_matches(products: DataFrame, **options) -> DataFrame:
    """The best matches as a written table, for reports that read them more than once."""
    return stage(match(products, **options), "matches")


SIZE_DIGITS = 6
CLEANED = (
    "product_id bigint, href string, name_only string, own_brand boolean, quantity double, unit string, price double, ingredients string"
)


def cleaned_sides(raw_a: DataFrame, raw_b: DataFrame, price_column: str, folder: str | None = None) -> DataFrame:
    """Two raw listings (RAW_TEXT and the field catalogue in ``schema``, with a ``product_id``) as side a and side b.

    Sizes are rounded, so that the text to encode does not show how a unit was converted. Listings of shop b without an
    ``href`` get their product id as one. With ``folder``, the cleaned catalogues are handed over as CSV files in it.
    """
    a = cleaning.add_features(cleaning.clean_text_catalogue(raw_a), "a")
    b = cleaning.add_features(cleaning.clean_field_catalogue(raw_b, price_column), "b")
    if "href" not in b.columns:
        b = b.withColumn("href", F.col("product_id").cast("string"))
    columns = [part.split()[0] for part in CLEANED.split(", ")]

    def side(products, name):
        products = products.withColumn("quantity", F.round("quantity", SIZE_DIGITS)).select(*columns)
        if folder is not None:
            files.write_csv(products, f"{folder}/{name}")
            products = files.read_csv(products.sparkSession, f"{folder}/{name}", CLEANED, strict=True, line_breaks=True)
        encoded = text.product_text(*(F.col(c) for c in ("name_only", "quantity", "unit", "ingredients")))
        return products.select(F.lit(name).alias("side"), *columns, encoded.alias("product_text")).drop("unit", "ingredients")

    return side(a, "a").unionByName(side(b, "b"))


def compare_raw(raw_a: DataFrame, raw_b: DataFrame, price_column: str, folder: str | None = None, **options) -> DataFrame:
    """From two raw listings to the price comparison of their matched products: clean, add features, match on the block
    keys of both shops' corpus (a staged table, before any pair is made), compare. ``options`` are those of ``prepare``."""
    return prices.price_comparison(predicted(cleaned_sides(raw_a, raw_b, price_column, folder), **options))
