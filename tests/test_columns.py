"""Column builders, value by value."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import features, html, nutrition, sequences, similarity, text, units
from shelfmatch.operators import cleaning


def values(spark, inputs, build, schema="x string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("x"))).collect()]


SIZES = {
    "500 gram": (0.5, "kg"),
    "10 stuks": (10.0, "stuk"),
    "2 pakketten": (2.0, "pak"),
    "4 lamskoteletten": (4.0, "l"),
    "1,5 liter": (1.5, "l"),
    "1 kilo": (1.0, "kg"),
    "3 zakjes": (3.0, "stuk"),
    "33 cl": (None, None),
    "6 x 33 cl": (1.98, None),
    "6 x 330 ml": (1.98, "l"),
    "4 x 2 rollen": (8.0, None),
    "2X 100 G": (0.1, "kg"),
    "1 kg": (1.0, "kg"),
    "12 plakjes": (None, None),
}


def test_sizes(spark):
    rows = spark.createDataFrame([(p,) for p in SIZES], "portion string")
    found = {r["portion"]: (r["quantity"] and round(r["quantity"], 6), r["unit"]) for r in cleaning.text_sizes(rows).collect()}
    assert found == SIZES


def test_strict_units_need_the_whole_word(spark):
    rows = spark.createDataFrame([("4 lamskoteletten",), ("500 gram",)], "portion string")
    found = [(r["quantity"], r["unit"]) for r in cleaning.text_sizes(rows, strict=True).collect()]
    assert found == [(None, None), (0.5, "kg")]


def test_field_sizes(spark):
    rows = spark.createDataFrame([(500.0, "g"), (33.0, "cl"), (2.0, "Tros"), (1.0, "doos"), (3.0, None)], "quantity double, unit string")
    found = [(r["quantity"], r["unit"]) for r in cleaning.field_sizes(rows).collect()]
    assert found == [(0.5, "kg"), (0.33, "l"), (2.0, "stuk"), (1.0, "doos"), (3.0, None)]


def test_name_without_size(spark):
    names = ["Volle melk 1,5 Liter", "Cola 6-pack", "Cola 6 pack", "Eieren 10 stuks", "Kaas", "500 g kaas", "Brood 1 st."]
    assert values(spark, names, units.name_without_size) == ["Volle melk", "Cola", "Cola", "Eieren", "Kaas", "500 g kaas", "Brood"]


def test_nutrient_text(spark):
    texts = [
        "Per 100g\\Energie (52 kcal)\\Vet1,5g\\Koolhydraten12g\\Vet2g\\Zout0,1g\\x",
        "Per 100g\\Energie 52 kJ",
        "geen waarden",
        "Per 100g\\52 kcal\\Vet 3.5g\\Eiwitten <0,5g\\Voedingsvezel1,2,3g\\rest",
        "Per 100g\\1 kcal\\Eiwitten4g\\Zout0,1g\\",
        "Per 100g\\1 kcal\\Zout0,1g",
    ]
    found = values(spark, texts, nutrition.from_text)
    shown = [{k: v for k, v in row.asDict().items() if v is not None} for row in found]
    assert shown == [
        {"kcal": 52.0, "fat_g": 2.0, "carbs_g": 12.0, "salt_g": 0.1},
        {}, {},
        {"kcal": 52.0},
        {"kcal": 1.0, "protein_g": 4.0, "salt_g": 0.1},
        {"kcal": 1.0},
    ]


def test_nutrient_map(spark):
    maps = [
        {"Energie kcal": "52", "Vet": "1.5", "waarvan onverzadigd Vet": "1", "Eiwit": "3", "Koolhydraten": "7", "overig": "n.v.t."},
        {"Zout": "spoor"},
        None,
    ]
    first, second, third = values(spark, maps, nutrition.from_map, "x map<string,string>")
    assert first.asDict() == {"kcal": 52.0, "carbs_g": 7.0, "fat_g": 1.0, "protein_g": 3.0, "salt_g": None, "readable": True}
    assert (second["salt_g"], second["readable"]) == (None, False)
    assert (third["kcal"], third["readable"]) == (None, True)


def test_diet_flags(spark):
    lists = [None, "Kip 80%", "tarwe, kip", "volle melk", "suiker, Allergenen: MELK", "tarwe, EI", "prei, ui", "eipoeder", "vis"]
    assert values(spark, lists, features.is_veggie) == [True, True, False, True, True, True, True, True, True]
    assert values(spark, lists, features.is_vegan) == [True, False, False, False, True, False, True, False, False]


def test_own_brand_has_no_word_boundary(spark):
    assert values(spark, ["1 DE BESTE kaas", "Kaas"], lambda x: features.is_own_brand(x, "a")) == [True, False]
    assert values(spark, ["AH kaas", "Bahlsen", "Kaas"], lambda x: features.is_own_brand(x, "b")) == [True, True, False]


def test_zero_divisors_are_null(spark):
    rows = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert rows.select(features.price_per_unit(F.col("a"), F.col("b"))).first()[0] is None


def test_tokens(spark):
    names = ["AH Müllermilk ½ l Aardbei", "De Zaanse Hoeve melk melk", "passie passiezaanlander & x_y", ""]
    assert values(spark, names, text.tokens) == [
        ["müllermilk", "½", "l", "aardbei"], ["melk", "melk"], ["passie", "x_y"], [],
    ]


def test_sorted_words_and_product_text(spark):
    assert values(spark, ["b  A\ta", "  "], text.sorted_words) == ["A a b", ""]
    row = spark.createDataFrame([("Kaas", 0.5, "kg", None)], "n string, q double, u string, i string")
    built = row.select(text.product_text(F.col("n"), F.col("q"), F.col("u"), F.col("i"))).first()[0]
    assert built == "Name: Kaas; Quantity: 0.5kg; Ingredients: "


PAGE = """<html><article><div class="title"><h1> Kaas <b>jong</b> &amp; oud </h1></div><p class="subtitle"> 500 g </p>
<div class="price big"><span class="price-large"> 3 </span><span class="price-small">49</span></div></article>
<article><h3>Omschrijving</h3><div class="body"><p>Lekker</p></div></article>
<article><div class="title"><h3>Ingrediënten</h3></div><div class="body"><p>Ingrediënten: <b>MELK</b>, zout</p><p>meer</p></div></article>
<ul class="nutrition"><div class="nutrition-item"><span>Energie kcal</span><span>300</span></div>
<div class="nutrition-item"><span>alleen</span></div>
<div class="nutrition-item"><span>Vet</span><span>1</span></div><div class="nutrition-item"><span>Vet</span><span>2</span></div></ul></html>"""


def test_page_fields(spark):
    def one(build):
        return values(spark, [PAGE], build)[0]

    assert one(html.title) == "Kaas jong & oud"
    assert one(html.portion) == "500 g"
    assert one(html.price) == 3.49
    assert one(html.ingredients) == "MELK, zout"
    assert one(html.nutrients) == {"Energie kcal": "300", "Vet": "2"}


def test_page_fields_that_are_missing(spark):
    pages = ['<div class="price"><span class="price-large">5</span></div>', "<p>x</p>", '<article><h3>Ingrediënten</h3><div class="body"></div></article>']
    assert values(spark, pages, html.price) == [0.05, None, None]
    assert values(spark, pages, html.ingredients) == [None, None, None]
    assert values(spark, pages, html.nutrients) == [None, None, None]


def test_absolute_links(spark):
    links = ["/a", "b", "//h/x", "http://o/p", "?q=1", "#t"]
    assert values(spark, links, lambda x: html.absolute(F.lit("https://s.nl/dir/page?z=1"), x)) == [
        "https://s.nl/a", "https://s.nl/dir/b", "https://h/x", "http://o/p", "https://s.nl/dir/page?q=1", "https://s.nl/dir/page?z=1#t",
    ]


def test_similarities_with_missing_or_zero_values(spark):
    rows = spark.createDataFrame([(2.0, 1.0), (1.0, None), (0.0, 0.0)], "a double, b double")
    found = rows.select(similarity.quantity_similarity(F.col("a"), F.col("b")), similarity.price_similarity(F.col("a"), F.col("b")))
    assert [tuple(r) for r in found.collect()] == [(0.25, 0.5), (None, None), (None, None)]


def test_jaccard(spark):
    rows = spark.createDataFrame([(["a", "b"], ["b"]), ([], []), (["a"], [])], "a array<string>, b array<string>")
    assert [r[0] for r in rows.select(similarity.jaccard(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]


def test_dot_product_and_fuzz_ratio(spark):
    rows = spark.createDataFrame(
        [(1, [1.0, 2.0], [3.0, 4.0], "abcd", "abxd"), (2, None, [1.0, 1.0], "", ""), (3, [0.0, 0.0], [1.0, 1.0], "a", ""), (4, [3.0, 0.0], [1.0, 0.0], None, "b")],
        "i int, x array<float>, y array<float>, s string, t string",
    )
    found = rows.select(
        "i", similarity.dot_product(F.col("x"), F.col("y")), similarity.cosine(F.col("x"), F.col("y")), similarity.fuzz_ratio(F.col("s"), F.col("t"))
    ).orderBy("i").collect()
    assert [(r[1], r[3]) for r in found] == [(11.0, 0.75), (None, 1.0), (0.0, 0.0), (3.0, None)]
    assert [r[2] for r in found[2:]] == [None, 1.0]


def test_reasons_for_missing_nutrients(spark):
    texts = [r"Per 100g\Energie (30 kcal)\Vet1.234,5g\Eiwitten <0,5g\Zout0,1g\x", "geen waarden", "", None, r"a\b\Vet.g\Vet2g\x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, nutrients string")
    why = [r[0] for r in rows.orderBy("i").select(nutrition.reasons_for_null(F.col("nutrients"))).collect()]
    assert (why[0]["kcal"], why[0]["fat_g"], why[0]["protein_g"], why[0]["salt_g"]) == (None, "no number", "missing", None)
    assert all(v == "missing" for row in why[1:4] for v in row) and why[4]["fat_g"] is None
    counts = {(r["column"], r["reason"]): r["n_values"] for r in cleaning.nutrient_problems(rows).collect()}
    assert counts["fat_g", "no number"] == 1 and counts["fat_g", "missing"] == 2 and counts["kcal", "missing"] == 3
    values = [r[0] for r in rows.orderBy("i").select(nutrition.from_text(F.col("nutrients"))).collect()]
    assert all((v[c] is None) == (w[c] is not None) for v, w in zip(values, why) for c in nutrition.TEXT_COLUMNS)
    assert cleaning.nutrient_problems(rows.limit(0)).agg(F.sum("n_values")).first()[0] == 0


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcé ", max_size=90), st.text("abcé ", max_size=90))
def test_common_length_equals_the_table(a, b):
    found = sequences.common_length(sequences.char_bits(a), len(a), b)
    assert found == table_lcs(a, b) == sequences.common_length(sequences.char_bits(b), len(b), a)


@pytest.mark.parametrize("table", [sequences.TABLE, 40])
def test_common_lengths_of_many_pairs(monkeypatch, table):
    """Texts of all lengths around a word, repeated ones, with letters beyond 16 bits, in chunks that are split or not."""
    monkeypatch.setattr(sequences, "TABLE", table)
    monkeypatch.setattr(sequences, "CHUNK", 300)
    draw = random.Random(5)

    def some(most):
        return "".join(draw.choices("ab é\U0001f9c0\u4e00xyz", k=draw.choice([0, 1, 63, 64, 65, draw.randrange(most)])))

    lefts = [some(90) for _ in range(1000)] + ["a" * 64, "a" * 64, "ab" * 32, "\ud800a", "", ""]
    rights = [draw.choice(lefts) if draw.random() < 0.3 else some(140) for _ in range(1000)] + ["a" * 600, "b", "ba" * 32, "a", "", "x"]
    found = sequences.common_lengths(lefts * 2, rights * 2).tolist()
    assert found == [table_lcs(a, b) for a, b in zip(lefts, rights)] * 2
    assert sequences.common_lengths([], []).tolist() == []


def test_long_names_are_compared_in_time():
    draw = random.Random(6)
    long = ["".join(draw.choices("abcdefghij ", k=33_000)) for _ in range(2)]
    begun = time.perf_counter()
    found = sequences.common_lengths(long, long[::-1])
    assert found[0] == found[1] > 15_000
    assert time.perf_counter() - begun < 3  # two comparisons


def test_missing_columns_fail_early(spark):
    with pytest.raises(ValueError, match="quantity, name_only"):
        cleaning.add_features(spark.createDataFrame([(1.0,)], "price double"), "a")


def test_stopwords_keep_the_joined_word():
    assert "passiezaanlander" in K.STOPWORDS and "passie" not in K.STOPWORDS
