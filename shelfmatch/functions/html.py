"""Fields of a product or overview page, read from its markup."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions.numbers import let, text_or_null

# Entities that occur in page texts; &amp; last, so that it is not read twice.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def plain(fragment: Column) -> Column:
    """Text of a markup fragment: tags out, entities in, blanks trimmed."""
    text = F.regexp_replace(fragment, "(?s)<[^>]*>", "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def joined(fragment: Column) -> Column:
    """Text of a markup fragment with each piece between tags trimmed and no blank put between them."""
    return plain(F.regexp_replace(F.replace(fragment, F.lit("&nbsp;"), F.lit(" ")), r"(?sU)\s*<[^>]*>\s*", ""))


_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TAG_END = r"(?=[\s/>])"


def _open(tag: str, css: str | None = None) -> str:
    """An opening tag in any case; with ``css``, one of that class, in any quotes or none."""
    kind = "" if css is None else (
        rf"""(?=(?:[^\s>"']++|"[^"]*+"|'[^']*+'|\s)*?\s(?i:class)\s*=\s*(?:"(?:[^"]*\s)?{css}(?:\s[^"]*)?"|'(?:[^']*\s)?{css}(?:\s[^']*)?'|{css}{_TAG_END}))""")
    return rf"<(?i:{tag}){_TAG_END}{kind}{_ATTRIBUTES}>"


def visible(html: Column) -> Column:
    """The page without comments."""
    return F.when(html.contains("<!--"), F.regexp_replace(html, "(?s)<!--.*?-->", "")).otherwise(html)


def _parts(markup: Column, tag: str) -> Column:
    """The markup cut before each tag of this name, opening or closing."""
    return F.split(markup, rf"(?=</?(?i:{tag}){_TAG_END})", -1)


def _depth(before: Column, part: Column, tag: str) -> Column:
    """How many elements of this name are open behind the tag that a part begins with."""
    opens = part.rlike(rf"\A{_open(tag)}") & ~part.rlike(r"\A<[^>]*/>")
    closes = part.rlike(rf"\A</(?i:{tag}){_TAG_END}")
    return before + opens.cast("int") - closes.cast("int")


def until_close(markup: Column, tag: str) -> Column:
    """What stands behind an opening tag up to its own closing tag, or to the end if it has none. Only where another
    element of this name opens before the first closing tag are the tags counted."""

    def step(now, part):
        counted = let(_depth(now["depth"], part, tag), lambda depth: F.struct(
            depth.alias("depth"), (now["i"] + 1).alias("i"), F.when(depth == 0, now["i"]).otherwise(F.lit(-1)).alias("end")
        ))
        return F.when(now["end"] >= 0, now).otherwise(counted)

    def read(parts):
        begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("i"), F.lit(-1).alias("end"))
        end = F.aggregate(parts, begin, step, lambda now: F.when(now["end"] >= 0, now["end"]).otherwise(now["i"]))
        return F.array_join(F.slice(parts, F.lit(1), end), "")

    first = F.get(F.split(markup, rf"</(?i:{tag}){_TAG_END}", 2), F.lit(0))
    return let(first, lambda inner: F.when(inner.rlike(rf"<(?i:{tag}){_TAG_END}"), let(_parts(markup, tag), read)).otherwise(inner))


def element(html: Column, tag: str, css: str | None = None) -> Column:
    """Inner markup of the first such element, with all elements inside it; null if there is none."""
    return let(F.get(F.split(html, _open(tag, css), 2), F.lit(1)), lambda rest: until_close(rest, tag))


def anchors(html: Column, css: str | None = None) -> Column:
    """Hrefs of the anchors in page order, of one class if given; empties dropped."""
    tags = F.regexp_extract_all(html, F.lit(_open("a", css)), F.lit(0))
    hrefs = F.transform(tags, lambda t: F.btrim(F.regexp_extract(t, r"""(?i)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1), F.lit("\"'")))
    return F.filter(hrefs, lambda h: h != "")


def _in_runs(parts: Column) -> Column:
    """The array in runs of about the square root of its length."""
    size = F.greatest(F.ceil(F.sqrt(F.size(parts))).cast("int"), F.lit(1))
    starts = F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)), size)
    return F.transform(starts, lambda start: F.slice(parts, start, size))


def anchors_inside(html: Column, container: str, css: str | None = None) -> Column:
    """The same, only for anchors inside elements of kind ``container``, however deep.

    An aggregate copies the array that it lengthens at each step, so the parts of the page are read in runs, and a run
    knows the depth that it begins at: a page of n parts costs n times the root of n short copies, not n times n.
    """
    none = F.array().cast("array<string>")

    def deeper(depth, part):
        return F.greatest(F.lit(0), _depth(depth, part, container))

    def begins(runs):
        def step(now, run):
            return F.struct(F.aggregate(run, now["depth"], deeper).alias("depth"), F.concat(now["all"], F.array(now["depth"])).alias("all"))

        return F.aggregate(runs, F.struct(F.lit(0).alias("depth"), F.array().cast("array<int>").alias("all")), step, lambda now: now["all"])

    def found(run, begin):
        def step(now, part):
            return let(deeper(now["depth"], part), lambda depth: F.struct(
                depth.alias("depth"), F.when(depth > 0, F.concat(now["found"], anchors(part, css))).otherwise(now["found"]).alias("found")
            ))

        return F.aggregate(run, F.struct(begin.alias("depth"), none.alias("found")), step, lambda now: now["found"])

    return let(_parts(html, container), lambda parts: let(_in_runs(parts), lambda runs: F.flatten(F.zip_with(runs, begins(runs), found))))


def absolute(base: Column, href: Column) -> Column:
    """Join a page address and a link: absolute links stay, ``//host``, ``/path`` and relative ones are completed."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(site, path, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(site, folder, href))
    )


def price(html: Column) -> Column:
    """Euros and cents from two spans of the first price box; a box with one span shows cents only. Prices of other
    products further down the page do not count."""

    def read(box):
        large = plain(element(box, "span", "price-large"))
        return let(plain(element(box, "span", "price-small")), lambda small: (
            F.when(small.isNotNull(), F.concat(large, F.lit("."), small))
            .otherwise(F.concat(F.lit("0."), F.lpad(large, 2, "0")))
            .try_cast("double")
        ))

    return let(element(html, "div", "price"), read)


def title(html: Column, box: str | None = None) -> Column:
    """The first heading; only inside the first element of class ``box``, if given."""
    return plain(element(element(html, "div", box) if box else html, "h1"))


def portion(html: Column) -> Column:
    return plain(element(html, "p", "subtitle"))


def ingredients(html: Column) -> Column:
    """First paragraph in the body of the section titled "Ingrediënten", without that word as a prefix. A body without a
    paragraph has none, whatever follows it."""
    heading = rf"{_open('h3')}\s*{K.INGREDIENTS_TITLE}\s*</(?i:h3)\s*>"
    section = F.get(F.filter(F.split(html, r"</(?i:article)\s*>"), lambda part: part.rlike(heading)), F.lit(0))
    after = F.get(F.split(section, heading, 2), F.lit(1))
    return F.regexp_replace(text_or_null(joined(element(element(after, "div", "body"), "p"))), K.INGREDIENTS_PREFIX, "")


def nutrients(html: Column) -> Column:
    """Label -> value map of the nutrition list; only items with exactly two spans count, a later label wins."""
    span = F.lit(rf"(?s){_open('span')}(.*?)</(?i:span)\s*>")

    def pairs(section):
        items = F.split(section, _open("div", "nutrition-item"))
        spans = F.transform(
            F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))),
            lambda item: F.transform(F.regexp_extract_all(until_close(item, "div"), span, F.lit(1)), plain),
        )
        return F.filter(spans, lambda s: F.size(s) == 2)

    def last_value(found, label):
        return F.element_at(F.filter(found, lambda p: p[0] == label), -1)[1]

    def to_map(found):
        labels = F.array_distinct(F.transform(found, lambda p: p[0]))
        return F.map_from_entries(F.transform(labels, lambda label: F.struct(label, last_value(found, label))))

    return let(element(html, "ul", "nutrition"), lambda section: let(pairs(section), to_map))
