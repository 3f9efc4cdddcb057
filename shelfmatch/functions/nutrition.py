"""Nutrient values from a nutrient text or from a label -> value map.

Both give one struct, so that a text or map is taken apart once for all its columns.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions.numbers import decimal_comma, let, text_or_null

_ENTRY = r"^(.+?)([\d.,]+)$"
_BLANKS = " \t\n\r\f\u000b\u00a0"


def _last(entries: Column, field: str, value: str) -> Column:
    """Value of the last entry whose field is ``value``."""
    return F.try_element_at(F.filter(entries, lambda e: e[field] == value), F.lit(-1))["value"]


def _texts(value: Column, body) -> Column:
    """``body`` of a struct with what a nutrient text says for each column, as text; null where it says nothing."""
    def entry(piece):
        return F.struct(
            F.regexp_extract(piece, _ENTRY, 1).alias("label"), F.regexp_extract(piece, _ENTRY, 2).alias("value")
        )

    def entries(parts):
        pieces = F.split(F.get(parts, F.lit(2)), r"g\\")
        listed = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
        return F.transform(listed, lambda piece: entry(F.btrim(piece, F.lit(_BLANKS))))

    def columns(parts):
        kcal = text_or_null(F.regexp_extract(F.get(parts, F.lit(1)), r"(\d+)\s*kcal", 1))
        return let(
            entries(parts),
            lambda found: body(F.struct(
                kcal.alias("kcal"), *[_last(found, "label", label).alias(name) for label, name in K.NUTRIENT_LABELS.items()]
            )),
        )

    return let(F.split(value, r"\\", 3), columns)


TEXT_COLUMNS = ("kcal", *K.NUTRIENT_LABELS.values())
MISSING, UNREADABLE = "missing", "no number"


def from_text(value: Column) -> Column:
    """Struct of the nutrients in a text like ``basis\\energy (n kcal)\\Vet1,5g\\...\\Zout0,1g\\x``.

    The piece after the last ``g\\`` is not read. Labels must fit exactly, a later duplicate wins, and a number that
    cannot be read is null; ``reasons_for_null`` says why a value is.
    """
    return _texts(value, lambda found: F.struct(*[decimal_comma(found[name]).alias(name) for name in TEXT_COLUMNS]))


def reasons_for_null(value: Column) -> Column:
    """Struct of why ``from_text`` has no value for a column: the text does not name it, or what stands there is no
    number; null where there is a value."""
    def reason(text):
        return F.when(text.isNull(), MISSING).when(decimal_comma(text).isNull(), UNREADABLE)

    return _texts(value, lambda found: F.struct(*[reason(found[name]).alias(name) for name in TEXT_COLUMNS]))


def _column_of(label: Column) -> Column:
    """Column a page label stands for, by the first part it contains; null for other labels."""
    parts = iter(K.PAGE_NUTRIENT_PARTS.items())
    part, name = next(parts)
    chain = F.when(label.contains(part), name)
    for part, name in parts:
        chain = chain.when(label.contains(part), name)
    return chain


def from_map(nutrients: Column) -> Column:
    """Struct of the nutrients in a label -> value map, and ``readable``: no value of theirs is something else than a
    number. Of several labels for a column the last one wins."""
    entries = F.transform(
        F.map_entries(nutrients), lambda e: F.struct(_column_of(e["key"]).alias("column"), e["value"].alias("value"))
    )
    return let(
        F.filter(entries, lambda e: e["column"].isNotNull()),
        lambda found: F.struct(
            *[_last(found, "column", name).try_cast("double").alias(name) for name in K.PAGE_NUTRIENT_PARTS.values()],
            F.coalesce(F.forall(found, lambda e: e["value"].try_cast("double").isNotNull()), F.lit(True)).alias("readable"),
        ),
    )
