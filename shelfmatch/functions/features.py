"""Row features of a product: value for money, diet, brand and macro shares."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions.numbers import ratio


def price_per_unit(price: Column, quantity: Column) -> Column:
    return ratio(price, quantity)


def without_allergens(ingredients: Column) -> Column:
    return F.substring_index(ingredients, K.ALLERGEN_MARK, 1)


def _found(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))


def is_veggie(ingredients: Column) -> Column:
    """No meat word, in the case given; unknown ingredients count as veggie."""
    return ~_found(without_allergens(ingredients), "|".join(K.MEAT_WORDS))


def is_vegan(ingredients: Column) -> Column:
    """No meat, dairy or egg word in any case, and no upper-case EI as a word; unknown ingredients count as vegan."""
    text = without_allergens(ingredients)
    words = "|".join(K.MEAT_WORDS + K.DAIRY_WORDS + K.EGG_WORDS)
    return ~(_found(text, f"(?iu){words}") | _found(text, K.EGG_EXACT))


def diet_class(veggie: Column, vegan: Column) -> Column:
    return F.when(vegan, "Vegan").when(veggie, "Veggie").otherwise("Meats")


def is_own_brand(name: Column, brands: str) -> Column:
    return name.rlike(f"(?iu){K.OWN_BRAND_PATTERNS[brands]}")


def protein_total(protein: Column, quantity: Column, unit: Column) -> Column:
    """Grams in the whole product: protein is per 100 g, quantity in kg or l."""
    return F.when(unit.isin("kg", "l"), protein * quantity * 10)


def macro_shares(carbs: Column, fat: Column, protein: Column, kcal: Column) -> dict[str, Column]:
    """Share of the energy that comes from each macro nutrient (4, 9 and 4 kcal per gram)."""
    return {
        "frac_kcal_carbs": ratio(carbs * 4, kcal),
        "frac_kcal_fat": ratio(fat * 9, kcal),
        "frac_kcal_protein": ratio(protein * 4, kcal),
    }
