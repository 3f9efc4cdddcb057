"""Queries on stored pages: links, the category tree and product fields."""

from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import html, nutrition
from shelfmatch.operators import pages
from shelfmatch.plans.registry import query
from shelfmatch.plans.views import table, view
from shelfmatch.sources.staging import fresh_path
from shelfmatch.streaming.incremental import load_pages_with_rejects

LINKS = (("links", """
select page_id, url, pos - 1 as pos, hrefs[pos] as href
from (select page_id, url, hrefs, unnest(range(1, len(hrefs) + 1)) as pos
  from (select page_id, url, regexp_extract_all(html, '<a [^>]*href="([^"]+)"', 1) as hrefs from pages) p) q"""),)
SITE = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
TITLE = """trim(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1),
  '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'))"""


@query("extract_links", "select page_id, cast(pos as integer) as pos, href from links", ctes=LINKS)
def extract_links(spark, folder):
    return pages.links(table(spark, folder, "pages")).select("page_id", "pos", "href")


@query("filter_links_notin", "select page_id, cast(pos as integer) as pos, href from links where href not in "
       "('/the', '/de', '/is')", ctes=LINKS)
def filter_links_notin(spark, folder):
    """Links without the excluded ones; the stored pages know other addresses than the shop's excluded categories."""
    found = pages.links(table(spark, folder, "pages"))
    return pages.without_excluded(found, ("/the", "/de", "/is")).select("page_id", "pos", "href")


@query("resolve_links", f"""
select page_id, cast(pos as integer) as pos, case when href like '/%' then {SITE} || href else href end as absolute_url
from links""", ctes=LINKS)
def resolve_links(spark, folder):
    return pages.with_absolute(pages.links(table(spark, folder, "pages"))).select("page_id", "pos", "absolute_url")


@query("explode_hierarchy", f"""
select {SITE} as cat, regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]*)', 1) as sub_cat,
  case when href like '/%' then {SITE} || href else href end as product from links""", ctes=LINKS)
def explode_hierarchy(spark, folder):
    """One row per (category, sub-category, product): site, first path part and link of the stored pages."""
    stored = table(spark, folder, "pages").withColumns({
        "cat": F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1),
        "sub_cat": F.regexp_extract("url", "^[a-z]+://[^/?#]*/([^/?#]*)", 1),
    })
    return pages.with_absolute(pages.links(stored)).select("cat", "sub_cat", F.col("absolute_url").alias("product"))


@query("category_tree", """
select distinct '/c/' || p_type || '/' as cat, '/c/' || p_type || '/' || replace(p_brand, '#', '') || '/' as sub_cat,
  'http://shop0.example/c/' || p_type || '/' || replace(p_brand, '#', '') || '/' || cast(p_partkey as varchar) as product from part""")
def category_tree(spark, folder):
    """Departments, brands and products of a stored shop, by following its links; pages may be stored twice."""
    site = view(spark, folder, "site")
    return pages.category_tree(site.unionAll(site), "http://shop0.example/")


@query("page_title", f"select page_id, {TITLE} as title from pages")
def page_title(spark, folder):
    return table(spark, folder, "pages").select("page_id", html.title(F.col("html")).alias("title"))


@query("page_rows", f"select p.page_id, url, {TITLE} as title, coalesce(n, 0) as n_links from pages p left join "
       "(select page_id, count(*) as n from links group by page_id) l on p.page_id = l.page_id", ctes=LINKS)
def page_rows(spark, folder):
    found = F.size(html.anchors(F.col("html"))).cast("bigint")
    return table(spark, folder, "pages").select("page_id", "url", html.title(F.col("html")).alias("title"), found.alias("n_links"))


@query("rejected_pages", "select url as href, case when not regexp_matches(html, 'class=\"title') then 'no title' "
       "when not regexp_matches(html, 'class=\"price') then 'no price' else 'no portion' end as problem from pages "
       "where not (regexp_matches(html, 'price-large') and regexp_matches(html, 'class=\"subtitle'))")
def rejected_pages(spark, folder):
    """The given pages are no product pages, so every one is rejected with its reason."""
    return pages.rejected_pages(pages.product_rows(table(spark, folder, "pages")))


# --- product pages made from the part table ---

BOX = "regexp_extract(html, '<div class=\"price\">(.*?)</div>', 1)"
LARGE = f"regexp_extract({BOX}, 'price-large\">([^<]*)<', 1)"
SMALL = f"regexp_extract({BOX}, 'price-small\">([^<]*)<', 1)"
PRICE = f"""case when {BOX} like '%price-small%' then try_cast({LARGE} || '.' || {SMALL} as double)
  when html like '%price-large%' then try_cast('0.' || case when length({LARGE}) < 2 then '0' else '' end || {LARGE} as double) end"""
INGREDIENTS = """nullif(regexp_replace(regexp_replace(regexp_extract(html, '<div class="body"><p>(.*?)</p>', 1), '\\s*<[^>]*>\\s*', '', 'g'),
  '^Ingrediënten\\s*:\\s*', ''), '')"""


def _item(label):
    return (f"nullif(regexp_extract(html, '<div class=\"nutrition-item\"><span>{label}</span><span>([^<]*)</span></div>', 1), '')")


NUTRIENTS = f"""try_cast({_item('Energie kcal')} as double) as kcal,
  try_cast({_item('Koolhydraten')} as double) as carbs_g, try_cast({_item('waarvan onverzadigd Vet')} as double) as fat_g,
  try_cast({_item('Eiwitten')} as double) as protein_g, try_cast({_item('Zout')} as double) as salt_g"""


@query("price_parts", f"select p_partkey, {PRICE} as price from product_pages", ("product_pages",))
def price_parts(spark, folder):
    return view(spark, folder, "product_pages").select("p_partkey", html.price(F.col("html")).alias("price"))


@query("page_ingredients", f"select p_partkey, {INGREDIENTS} as ingredients from product_pages", ("product_pages",))
def page_ingredients(spark, folder):
    return view(spark, folder, "product_pages").select("p_partkey", html.ingredients(F.col("html")).alias("ingredients"))


@query("page_nutrition", f"""
select p_partkey, label, value from (
  select p_partkey, unnest(['Energie kcal', 'Vet', 'Koolhydraten', 'Zout', 'waarvan onverzadigd Vet', 'Eiwitten']) as label,
    unnest([{_item('Energie kcal')}, {_item('Vet')}, {_item('Koolhydraten')}, {_item('Zout')}, {_item('waarvan onverzadigd Vet')}, {_item('Eiwitten')}]) as value
  from product_pages) t where value is not null""", ("product_pages",))
def page_nutrition(spark, folder):
    return view(spark, folder, "product_pages").select("p_partkey", F.explode(html.nutrients(F.col("html"))).alias("label", "value"))


@query("nutrient_columns", f"select p_partkey, {NUTRIENTS} from product_pages", ("product_pages",))
def nutrient_columns(spark, folder):
    values = nutrition.from_map(html.nutrients(F.col("html")))
    return view(spark, folder, "product_pages").select("p_partkey", values.alias("values")).select("p_partkey", "values.*").drop("readable")


@query("strip_prefix", "select p_partkey, regexp_replace(ingredients, '^Ingrediënten\\s*:\\s*', '') as ingredients from raw_a",
       ("raw_a",))
def strip_prefix(spark, folder):
    cleaned = F.regexp_replace("ingredients", K.INGREDIENTS_PREFIX, "")
    return view(spark, folder, "raw_a").select("p_partkey", cleaned.alias("ingredients"))


@query("product_page_rows", f"""
select url as href, sub_cat, p_name || ' & co' as name, {PRICE} as price, cast(p_size as varchar) || ' gram' as portion,
  {INGREDIENTS} as ingredients, {NUTRIENTS}
from product_pages join part using (p_partkey)
where html like '%price-large%' and not (html like '%spoor%')""", ("product_pages",))
def product_page_rows(spark, folder):
    rows = pages.usable_products(pages.product_rows(view(spark, folder, "product_pages")))
    return rows.select("href", "sub_cat", "name", "price", "portion", "ingredients", "kcal", "carbs_g", "fat_g", "protein_g", "salt_g")


@query("rejected_product_pages", """
select url as href, case when html not like '%price-large%' then 'no price' else 'bad nutrient' end as problem
from product_pages where html not like '%price-large%' or html like '%spoor%'""", ("product_pages",))
def rejected_product_pages(spark, folder):
    return pages.rejected_pages(pages.product_rows(view(spark, folder, "product_pages")))


@query("streamed_load", """
select url as href, case when html not like '%price-large%' then 'no price' when html like '%spoor%' then 'bad nutrient' end as problem
from product_pages""", ("product_pages",))
def streamed_load(spark, folder):
    """Pages that arrive in two portions are loaded as a stream, run after run; each ends as a product or as a reject."""
    source, products, rejects, checkpoint = (fresh_path(spark, n) for n in ("pages-in", "products", "rejects", "stream-state"))
    stored = view(spark, folder, "product_pages").select("url", "html", F.col("sub_cat").cast("string").alias("sub_cat"))
    for part in (0, 1, 2):  # the last brings nothing
        stored.where(F.pmod(F.xxhash64("url"), F.lit(2)) == part).write.mode("append").parquet(source)
        load_pages_with_rejects(spark, source, products, rejects, checkpoint, "url string, html string, sub_cat string")
    good = spark.read.parquet(products).select("href", F.lit(None).cast("string").alias("problem"))
    return good.unionByName(spark.read.parquet(rejects).select("href", "problem"))
