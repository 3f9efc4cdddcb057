"""Raw listings to products: filters, size parsing, nutrient columns and row features. Projections only, no shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import features, nutrition, units

NUMERIC = ("price", "kcal", "quantity", "carbs_g", "fat_g", "protein_g", "salt_g")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail while the plan is built, not on the executors, if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_link(raw: DataFrame) -> DataFrame:
    """Rows that have a link; repeated header lines of an appended file have none."""
    return raw.where(F.col("href").contains("http"))


def with_portion(raw: DataFrame) -> DataFrame:
    return raw.where(F.coalesce(F.col("portion").contains(" "), F.lit(False)))


def to_numbers(df: DataFrame, columns=NUMERIC) -> DataFrame:
    """Doubles; text that is no number becomes null and is counted by ``unreadable_numbers``."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


def unreadable_numbers(df: DataFrame, columns=NUMERIC) -> DataFrame:
    """Per numeric column, how many values would be lost by the cast; one pass."""
    lost = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in columns if c in df.columns]
    return df.agg(*lost)


def nutrient_problems(raw: DataFrame) -> DataFrame:
    """For listings with a nutrient text: (column, reason, n_values), how many values each column lacks and why, zeros
    included; one pass. Listings without a text are no food and do not count."""
    reasons = raw.where("nutrients is not null").select(nutrition.reasons_for_null(F.col("nutrients")).alias("why"))
    kinds = [(c, why) for c in nutrition.TEXT_COLUMNS for why in (nutrition.MISSING, nutrition.UNREADABLE)]
    counts = reasons.agg(*[F.count_if(F.col(f"why.{c}") == why).alias(f"n{i}") for i, (c, why) in enumerate(kinds)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(why).alias("reason"), F.col(f"n{i}").alias("n_values"))
        for i, (c, why) in enumerate(kinds)
    ])
    return counts.select(F.inline(rows))


def text_sizes(df: DataFrame, strict=False) -> DataFrame:
    """Quantity and unit from the portion text, in kg, l or pieces; a multipack sets the quantity but not the unit."""
    portion, word = F.col("portion"), F.col("_word")
    read = df.withColumns({
        "_amount": units.quantity(portion, strict),
        "_word": units.unit_word(portion, strict),
        "_pack": units.multipack_quantity(portion),
    })
    sized = read.withColumns({
        "quantity": F.coalesce("_pack", units.base_quantity(F.col("_amount"), word, K.BASE_UNITS_TEXT)),
        "unit": units.base_unit(word, K.BASE_UNITS_TEXT),
    })
    return sized.drop("_amount", "_word", "_pack")


def field_sizes(df: DataFrame) -> DataFrame:
    """The same for catalogues with quantity and unit fields."""
    word = F.col("unit")
    return df.withColumns({
        "quantity": units.base_quantity(F.col("quantity"), word, K.BASE_UNITS_FIELDS),
        "unit": units.base_unit(word, K.BASE_UNITS_FIELDS),
    })


def clean_text_catalogue(raw: DataFrame, strict_units=False) -> DataFrame:
    """Shop with portion texts and nutrient columns (RAW_TEXT in ``schema``)."""
    kept = with_portion(with_link(raw.drop("nutrients")))
    sized = text_sizes(kept, strict_units).withColumn("name_only", units.name_without_size(F.col("name")))
    return to_numbers(sized)


def project_fields(raw: DataFrame, price_column: str) -> DataFrame:
    """The columns used, renamed; of the price snapshots only the one asked for."""
    return raw.select(
        F.col("prod_desc").alias("name"), F.col(price_column).alias("price"),
        F.col("quantity_value").alias("quantity"), F.col("quantity_unit").alias("unit"),
        "ingredients", "labels", "nutrients", *[c for c in ("p_partkey", "product_id", "href") if c in raw.columns],
    )


def clean_field_catalogue(raw: DataFrame, price_column: str) -> DataFrame:
    """Shop with size fields and a nutrient text (RAW_FIELDS in ``schema``); rows without nutrients are no food."""
    food = project_fields(raw, price_column).na.drop(subset=["nutrients"])
    parsed = food.withColumn("values", nutrition.from_text(F.col("nutrients"))).select("*", "values.*").drop("values", "nutrients")
    return field_sizes(parsed).withColumn("name_only", units.name_without_size(F.col("name")))


def add_features(products: DataFrame, brands: str) -> DataFrame:
    """Value, diet, brand and macro columns. ``brands``: whose own brands, a key of ``OWN_BRAND_PATTERNS``."""
    require(products, "price", "quantity", "name_only")
    c = F.col
    total = features.protein_total(c("protein_g"), c("quantity"), c("unit"))
    return products.withColumns({
        "price_per_unit": features.price_per_unit(c("price"), c("quantity")),
        "veggie": features.is_veggie(c("ingredients")),
        "vegan": features.is_vegan(c("ingredients")),
        "own_brand": features.is_own_brand(c("name"), brands),
        "protein_total_g": total,
        "protein_per_euro": features.ratio(total, c("price")),
        **features.macro_shares(c("carbs_g"), c("fat_g"), c("protein_g"), c("kcal")),
    })
