"""Page fields out of nested markup, in any quotes and case, and size patterns on very long names."""

import re
import time

import pytest
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import html, units


def read(spark, markup, field, *args):
    return spark.createDataFrame([(markup,)], "html string").select(field(F.col("html"), *args).alias("v")).first()["v"]


@pytest.mark.parametrize("box, price", [
    ('<div class="price"><div class="old">x</div><span class="price-large">89</span><span class="price-small">49</span></div>', 89.49),
    ("<DIV CLASS='big price now'><div><div>9,99</div></div><SPAN class=price-large>1</SPAN><span class='price-small'>05</span></DIV>", 1.05),
    ('<div class="prices"><span class="price-large">7</span></div><div id="a>b" class="price"><span class="price-large">5</span></div>', 0.05),
    ('<div class="price"><div class="old"></div></div><span class="price-large">89</span>', None),
    ('<div class="price"><span class="price-large">3</span><span class="price-small">10</span>', 3.1),
])
def test_price_of_its_own_box(spark, box, price):
    assert read(spark, f"<html><body>{box}<p>tail</p></body></html>", html.price) == price


def test_title_and_portion(spark):
    page = "<div class='title'><div class=\"logo\"><div>x</div></div><H1 id=t>Oude <b>kaas</b></H1><p CLASS='subtitle small'>500 g</p></div><h1>other</h1>"
    assert read(spark, page, html.title, "title") == "Oude kaas" and read(spark, page, html.portion) == "500 g"
    assert read(spark, "<div class='title'><div>x</div></div><h1>outside</h1>", html.title, "title") is None
    assert read(spark, "<!-- <h1>old</h1> --><h1>new</h1>", lambda h: html.title(html.visible(h))) == "new"


def test_ingredients_stay_in_their_body(spark):
    def page(body):
        return f"<article><h3>Ingrediënten</h3>{body}<p>Bewaaradvies</p></article><article><div class='body'><p>later</p></div></article>"

    assert read(spark, page('<div class="body"></div>'), html.ingredients) is None
    assert read(spark, page("<div class='body'><div><div></div><P>Ingrediënten: melk</P></div></div>"), html.ingredients) == "melk"
    assert read(spark, page('<div class="other"><p>no</p></div>'), html.ingredients) is None


def test_nutrition_items_end_with_themselves(spark):
    page = ("<UL class='nutrition'><div class='nutrition-item'><span>Vet</span><span>2</span></div><span>stray</span>"
            "<div class='nutrition-item'><div><SPAN>Zout</SPAN></div><span>1</span></div><ul></ul><div class=nutrition-item><span>Eiwitten</span><span>3</span></div></UL>")
    assert read(spark, page, html.nutrients) == {"Vet": "2", "Zout": "1", "Eiwitten": "3"}


def test_links(spark):
    page = "<a href='/one' class='x top'>1</a><A CLASS=top HREF=/two>2</A><abbr href='/no'>n</abbr><ul><li><ul><li>a</li></ul><a href=\"/three\">3</a></li></ul><a href=''>e</a>"
    assert read(spark, page, html.anchors) == ["/one", "/two", "/three"]
    assert read(spark, page, html.anchors, "top") == ["/one", "/two"]
    assert read(spark, page, html.anchors_inside, "li") == ["/three"]


def test_very_deep_and_long_pages(spark):
    deep = '<div class="price">' + "<div>" * 2000 + "</div>" * 2000 + '<span class="price-large">4</span></div>'
    assert read(spark, deep, html.price) == 0.04
    assert read(spark, f"<h1 title='{'x' * 200_000}'>long</h1>", html.title) == "long"


# The patterns as they read without the conditions that keep them linear.
PLAIN = {
    "SIZE_PATTERN": rf"({K.NUMBER})\s*({K.UNIT_WORDS})",
    "TRAILING_SIZE_PATTERN": rf"(?i)\s*(?:{K.NUMBER}\s*(?:{K.UNIT_WORDS})|\d+\s*-?\s*pack)\s*$",
    "MULTIPACK_PATTERN": rf"(\d+)\s*x\s*({K.NUMBER})\s*([a-zA-Z]+)",
}


@pytest.mark.parametrize("name", PLAIN)
def test_patterns_find_what_the_plain_ones_find(spark, name):
    import random

    draw = random.Random(5)
    pieces = ["1", "12", "1.5", "2,25", ".", ",", " ", "  ", "g", "kg", "l", "x", "-", "pack", "Pack", "stuks", "melk", "\t", "ml"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(1, 9))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [(r.t, r.v) for r in rows.select("t", F.regexp_extract("t", getattr(K, name), 0).alias("v")).collect()]
    plain = re.compile(PLAIN[name])
    assert [v for _, v in found] == [m.group() if (m := plain.search(t)) else "" for t, _ in found]


@pytest.mark.parametrize("text", [" " * 40_000 + "x", "1" * 40_000 + "x", "1" + " " * 40_000 + "x", "1 g" + " " * 40_000 + "x", "1 x" + " " * 40_000, "1-" + " " * 40_000 + "p"])
def test_very_long_names_are_read_in_linear_time(spark, text):
    rows = spark.createDataFrame([(text,)], "t string")
    columns = [f(F.col("t")).alias(f"c{i}") for i, f in enumerate((units.name_without_size, units.quantity_text, units.unit_word, units.multipack_quantity))]
    spark.createDataFrame([("a 1 kg",)], "t string").select(*columns).collect()
    start = time.perf_counter()
    assert len(rows.select(*columns).collect()) == 1
    assert time.perf_counter() - start < 3  # Spark's own share included; quadratic patterns take a minute


def test_anchors_of_a_very_long_page(spark):
    def page(n):
        return "<a href='/no'>x</a>" + "".join(f"<li><li></li><a href='/{i}'>x</a></li><a href='/no'>x</a>" for i in range(n))

    for n in (0, 1, 2, 3, 50):
        assert read(spark, page(n), html.anchors_inside, "li") == [f"/{i}" for i in range(n)]
    began = time.time()
    assert read(spark, page(20_000), html.anchors_inside, "li") == [f"/{i}" for i in range(20_000)]
    assert time.time() - began < 20  # each part used to copy all anchors found before it


def test_element_without_nested_ones_reads_no_further(spark):
    page = "<div class='price'><span class=price-large>1</span><span class=price-small>05</span></div>" + "<div><div>x</div></div>" * 300
    for markup in ("x</div >y", "x</DIV>y", "x<div/>y</div>z", "x<div>y</div>z</div>w", "x<divan>y</div>", "x"):
        want = {"x</div >y": "x", "x</DIV>y": "x", "x<div/>y</div>z": "x<div/>y", "x<div>y</div>z</div>w": "x<div>y</div>z", "x<divan>y</div>": "x<divan>y", "x": "x"}
        assert read(spark, markup, html.until_close, "div") == want[markup]
    pages = spark.range(2000).select(F.lit(page).alias("html"))
    began = time.time()
    assert pages.select(html.price(F.col("html")).alias("price")).where("price = 1.05").count() == 2000
    assert time.time() - began < 20
