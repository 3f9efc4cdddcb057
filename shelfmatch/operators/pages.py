"""Stored pages to rows: links, the category tree and product fields."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import html, nutrition

PRODUCT_COLUMNS = ("href", "sub_cat", "name", "price", "portion", "ingredients", "nutrients")


def links(pages: DataFrame, css: str | None = None) -> DataFrame:
    """One row per link of a page, in page order."""
    return pages.select("*", F.posexplode(html.anchors(F.col("html"), css)).alias("pos", "href")).drop("html")


def without_excluded(rows: DataFrame, excluded=K.EXCLUDED_CATEGORIES, column="href") -> DataFrame:
    return rows.where(~F.col(column).isin(*excluded))


def with_absolute(rows: DataFrame, base="url", column="href") -> DataFrame:
    return rows.withColumn("absolute_url", html.absolute(F.col(base), F.col(column)))


def category_tree(pages: DataFrame, start: str) -> DataFrame:
    """(cat, sub_cat, product) of a stored site: departments on the start page, their sub-categories on the category
    pages, products on the sub-category pages. Pages are looked up by joins on their address."""
    pages = pages.groupBy("url").agg(F.max("html").alias("html"))  # a page may have been stored twice
    home = pages.where(F.col("url") == start)
    cats = without_excluded(links(home, "department")).select(F.col("href").alias("cat")).distinct()
    cats = cats.withColumn("url", html.absolute(F.lit(start), F.col("cat")))
    subs = cats.join(pages, "url").select("cat", F.explode(html.anchors_inside(F.col("html"), "li")).alias("sub_cat"))
    subs = subs.where(F.col("sub_cat").contains(F.col("cat"))).distinct()
    subs = subs.withColumn("url", html.absolute(F.lit(start), F.col("sub_cat")))
    items = subs.join(pages, "url").select(
        "cat", "sub_cat", F.explode(html.anchors_inside(F.col("html"), "article", "top")).alias("href")
    )
    found = items.where(F.col("href").contains(F.col("sub_cat")))
    return found.select("cat", "sub_cat", html.absolute(F.lit(start), F.col("href")).alias("product"))


def product_rows(pages: DataFrame) -> DataFrame:
    """All product fields of a page in one pass, with ``problem`` naming why a page is unusable.

    The fields come out of a one-row ``inline``: a filter on them stays above it, while through a projection the
    optimizer would push it down and read every page again for the filter.
    """
    page = html.visible(F.col("html"))
    read = F.struct(
        html.title(page, "title").alias("name"), html.price(page).alias("price"), html.portion(page).alias("portion"),
        html.ingredients(page).alias("ingredients"), html.nutrients(page).alias("nutrients"),
    )
    kept = [c for c in pages.columns if c not in ("html", "url", "sub_cat")]
    sub_cat = "sub_cat" if "sub_cat" in pages.columns else F.lit(None).cast("string").alias("sub_cat")
    fields = pages.select(*kept, F.col("url").alias("href"), sub_cat, F.inline(F.array(read)))
    parsed = fields.select("*", F.inline(F.array(nutrition.from_map(F.col("nutrients")))))
    return parsed.withColumn(
        "problem",
        F.when(F.col("name").isNull(), "no title").when(F.col("price").isNull(), "no price")
        .when(F.col("portion").isNull(), "no portion")
        .when(~F.col("readable"), "bad nutrient"),
    ).drop("readable")


def usable_products(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNull()).drop("problem")


def rejected_pages(rows: DataFrame) -> DataFrame:
    """One bad page costs that page only; this lists them."""
    return rows.where(F.col("problem").isNotNull()).select("href", "problem")
