"""Tokens and product texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch import constants as K

WORD = r"[\p{L}\p{N}_]+"  # what a Unicode \w+ matches; Java's plain \w is ASCII


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def tokens(name: Column) -> Column:
    """Words of a name in order, repeats kept, stopwords dropped."""
    return F.filter(words(name), lambda t: ~t.isin(*K.STOPWORDS))


def sorted_words(name: Column) -> Column:
    """Blank-separated words in order of their code points, case kept; the form that the fuzzy score compares."""
    parts = F.filter(F.split(name, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(parts), " ")


def product_text(name: Column, quantity: Column, unit: Column, ingredients: Column) -> Column:
    def shown(column):
        return F.coalesce(column.cast("string"), F.lit(""))

    return F.concat(
        F.lit("Name: "), shown(name),
        F.lit("; Quantity: "), shown(quantity), shown(unit),
        F.lit("; Ingredients: "), shown(ingredients),
    )
