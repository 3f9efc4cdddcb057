"""Price distribution, protein and diet reports over products with features."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import features
from shelfmatch.operators.ordered import running_totals

MACROS = ("frac_kcal_carbs", "frac_kcal_fat", "frac_kcal_protein")
PRICE_RANGE = (0.0, 15.0)


def valid_products(products: DataFrame, limit=K.MACRO_SHARE_LIMIT) -> DataFrame:
    """No macro share above the limit (4 kcal per gram is an approximation); unknown shares fail."""
    for column in MACROS:
        products = products.where(F.col(column) <= limit)
    return products


def clip(column, bounds=PRICE_RANGE):
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(bounds[0])), F.lit(bounds[1])))


def price_stats(products: DataFrame) -> DataFrame:
    """Count, mean and exact median of the price per shop.

    Equal prices are counted first; the median is read off running counts, so no shop's prices meet in one task.
    """
    counts = products.where(F.col("price").isNotNull()).groupBy("shop", "price").agg(F.count(F.lit(1)).alias("rows"))
    ranked = running_totals(counts, ["price"], {"upto": "rows"}, within=("shop",))
    means = products.groupBy("shop").agg(
        F.count(F.lit(1)).alias("n_products"), F.avg("price").alias("mean_price")
    )
    first, second = F.floor((F.col("upto_all") - 1) / 2), F.floor(F.col("upto_all") / 2)  # 0-based middle positions

    def holds(position):
        return (F.col("upto") - F.col("rows") <= position) & (position < F.col("upto"))

    middle = ranked.where(holds(first) | holds(second))  # two rows per shop at most
    median = (F.max(F.when(holds(first), F.col("price"))) + F.max(F.when(holds(second), F.col("price")))) / 2
    return middle.groupBy("shop").agg(median.alias("median_price")).join(means, "shop")


def price_density(products: DataFrame, points=200, cut=3.0) -> DataFrame:
    """Gaussian density of the clipped price per shop on an even grid, bandwidth by Scott's rule.

    The kernel is summed over distinct prices with their counts, with partial sums per grid point before the shuffle.
    """
    prices = products.select("shop", clip(F.col("price")).alias("price")).where(F.col("price").isNotNull())
    counts = prices.groupBy("shop", "price").agg(F.count(F.lit(1)).alias("rows"))
    shape = prices.groupBy("shop").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("price").alias("sd"), F.min("price").alias("low"), F.max("price").alias("high")
    )
    shape = shape.withColumn("width", F.col("sd") * F.pow(F.col("n"), F.lit(-0.2)))
    start, end = F.col("low") - cut * F.col("width"), F.col("high") + cut * F.col("width")
    grid = counts.join(shape, "shop").select(
        "shop", "price", "rows", "n", "width", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
        start.alias("start"), end.alias("end"),
    )
    x = F.col("start") + F.col("point") * (F.col("end") - F.col("start")) / (points - 1)
    z = (x - F.col("price")) / F.col("width")
    scale = F.col("n") * F.col("width") * F.sqrt(F.lit(2.0) * F.pi())
    kernel = F.col("rows") * F.exp(-z * z / 2) / scale
    return grid.groupBy("shop", "point").agg(F.min(x).alias("x"), F.sum(kernel).alias("density"))


def top_products(products: DataFrame, column: str, key: str, k=5) -> DataFrame:
    """The k largest values, known ones only, ties by key."""
    return products.where(F.col(column).isNotNull()).orderBy(F.desc(column), key).limit(k)


def share_non_vegan(products: DataFrame, thresholds=(0.0, 0.2)) -> DataFrame:
    """Share of products that are not vegan among those whose protein share exceeds each threshold; one pass."""
    share = F.col("frac_kcal_protein")
    cells = [F.avg(F.when(share > t, 1.0 - F.col("vegan").cast("int"))).alias(f"share_{i}") for i, t in enumerate(thresholds)]
    rows = [c for i, t in enumerate(thresholds) for c in (F.lit(float(t)), F.col(f"share_{i}"))]
    return products.agg(*cells).select(F.stack(F.lit(len(thresholds)), *rows).alias("threshold", "share_non_vegan"))


def with_diet(products: DataFrame) -> DataFrame:
    return products.withColumn("diet", features.diet_class(F.col("veggie"), F.col("vegan")))


def affordability_points(products: DataFrame, threshold=0.2) -> DataFrame:
    """Protein share against protein per euro, per diet."""
    rich = with_diet(products).where(F.col("frac_kcal_protein") > threshold)
    return rich.select("diet", F.col("frac_kcal_protein").alias("x"), F.col("protein_per_euro").alias("y"), F.col("name").alias("label"))


def fat_protein_points(products: DataFrame) -> DataFrame:
    return with_diet(products).select(
        "diet", F.col("frac_kcal_protein").alias("x"), F.col("frac_kcal_fat").alias("y"), F.col("name").alias("label")
    )


def macro_points(products: DataFrame) -> DataFrame:
    """Three macro shares per product, with name, price and protein per euro to show on hover."""
    x, y, z = MACROS
    return with_diet(products).select(
        "diet", F.col(x).alias("x"), F.col(y).alias("y"), F.col(z).alias("z"), F.col("name").alias("label"), "price", "protein_per_euro"
    )
