"""Sizes in listing texts: name without size, quantity, unit, scaling to a base unit, multipacks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions.numbers import decimal_comma, lookup, text_or_null


def name_without_size(name: Column) -> Column:
    return F.regexp_replace(name, K.TRAILING_SIZE_PATTERN, "")


def quantity_text(portion: Column, strict: bool = False) -> Column:
    pattern = K.STRICT_SIZE_PATTERN if strict else K.SIZE_PATTERN
    return text_or_null(F.regexp_extract(F.lower(portion), pattern, 1))


def quantity(portion: Column, strict: bool = False) -> Column:
    return decimal_comma(quantity_text(portion, strict))


def unit_word(portion: Column, strict: bool = False) -> Column:
    """Unit after the first number. ``strict`` asks for the whole word, so "4 lamskoteletten" is not 4 l."""
    pattern = K.STRICT_SIZE_PATTERN if strict else K.SIZE_PATTERN
    return text_or_null(F.regexp_extract(F.lower(portion), pattern, 2))


def canonical_unit(unit: Column) -> Column:
    return lookup(unit, K.UNIT_SYNONYMS, unit)


def _with_synonyms(table: dict) -> dict:
    """The base-unit table for units as written: synonyms first, so that one lookup does both steps."""
    written = {word: table.get(unit, (unit, 1)) for word, unit in K.UNIT_SYNONYMS.items()}
    return {**table, **written}


def base_quantity(amount: Column, word: Column, table: dict) -> Column:
    divisors = {w: float(divisor) for w, (_, divisor) in _with_synonyms(table).items()}
    return amount / lookup(word, divisors, F.lit(1.0))


def base_unit(word: Column, table: dict) -> Column:
    return lookup(word, {w: base for w, (base, _) in _with_synonyms(table).items()}, word)


def multipack_quantity(portion: Column) -> Column:
    """Total of an "n x size unit" text, in base units; null if the text is no multipack."""
    count = text_or_null(F.regexp_extract(portion, K.MULTIPACK_PATTERN, 1)).try_cast("double")
    size = decimal_comma(F.regexp_extract(portion, K.MULTIPACK_PATTERN, 2))
    unit = F.lower(F.regexp_extract(portion, K.MULTIPACK_PATTERN, 3))
    return count * size * lookup(unit, K.MULTIPACK_FACTORS, F.lit(1.0))
