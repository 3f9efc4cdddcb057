"""Catalogue-shaped views on the given tables, in SQL text that Spark and DuckDB both run.

``part`` stands in for the raw listings of two shops (every part is sold by both), ``documents`` for products with
free-text names: the first sentence (or line) is the name, the rest the ingredients, so the whole text is used.
"""

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")

RAW_A = """
select p_partkey, p_brand as sub_cat, href, case when p_partkey % 6 = 0 then '1 de Beste ' else '' end || p_name || ' ' || portion as name, portion,
  case when href = 'href' then 'price' else cast(price as string) end as price, ingredients,
  cast(kcal as string) as kcal, cast(carbs_g as string) as carbs_g, cast(fat_g as string) as fat_g,
  cast(protein_g as string) as protein_g, cast(salt_g as string) as salt_g
from (
  select p_partkey, p_brand, p_name,
    case when p_partkey % 97 = 0 then 'href' else 'http://shop0.example/p/' || cast(p_partkey as string) end as href,
    case p_partkey % 14
      when 0 then cast(p_size * 10 as string) || ' gram'
      when 1 then cast(p_size as string) || ' kilo'
      when 2 then '6 x ' || cast(p_size * 10 as string) || ' ml'
      when 3 then '6 x ' || cast(p_size as string) || ' cl'
      when 4 then cast(p_size as string) || ' cl'
      when 5 then cast(p_size as string) || ' lamskoteletten'
      when 6 then cast(p_size as string) || ' stuks'
      when 7 then cast(p_size as string) || ' st.'
      when 8 then cast(p_size as string) || ' pakketten'
      when 9 then '1,' || cast(p_size as string) || ' liter'
      when 10 then cast(p_size as string) || ' plakjes'
      when 11 then 'stuk'
      when 12 then cast(p_size as string) || ' zakjes'
      else '2X ' || cast(p_size as string) || ' G' end as portion,
    p_retailprice as price,
    case p_partkey % 11
      when 0 then null
      when 1 then 'Ingrediënten: Kip 80%, zout'
      when 2 then 'tarwe, kip'
      when 3 then 'volle MELK, suiker'
      when 4 then 'suiker, Allergenen: MELK, EI'
      when 5 then 'tarwe, EI, zout'
      when 6 then 'prei, ui'
      when 7 then 'EIPOEDER, bloem'
      when 8 then 'VIS, water'
      when 9 then 'vis, water'
      else 'Ingrediënten : weinig zout' end as ingredients,
    case when p_size % 9 = 0 then 0 else p_size * 8 end as kcal,
    p_size % 7 as carbs_g, p_size % 5 as fat_g,
    case when p_size % 10 = 0 then null else p_size % 6 end as protein_g,
    cast(p_size % 3 as double) / 10 as salt_g
  from part) t
"""

RAW_B = """
select p_partkey, case when p_partkey % 3 = 0 then '' else 'AH ' end || p_name || case p_partkey % 4 when 0 then ' 500 g' when 1 then ' 6-pack' when 2 then '' else ' 1,5 Liter' end as prod_desc,
  p_retailprice as price_2026_03_14, cast(p_size as double) as quantity_value,
  case p_partkey % 7 when 1 then 'g' when 2 then 'ml' when 3 then 'cl' when 4 then 'Tros' when 5 then 'kilo' when 6 then 'stuks' else 'l' end as quantity_unit,
  case p_partkey % 3 when 0 then null when 1 then 'water, vis' else 'MELK' end as ingredients,
  p_type as labels,
  case p_partkey % 5
    when 0 then null
    when 1 then 'geen waarden'
    when 2 then 'Per 100g' || chr(92) || 'Energie ' || cast(p_size * 4 as string) || ' kJ'
    when 3 then 'Per 100g' || chr(92) || 'Energie (' || cast(p_size as string) || ' kcal)' || chr(92) || 'Vet' || case p_size % 8 when 0 then '1.' else '' end || cast(p_size as string) || ',5g' || chr(92)
         || 'waarvan verzadigd1g' || chr(92) || 'Eiwitten <0,5g' || chr(92) || 'Zout0,1g'
    else 'Per 100g' || chr(92) || 'Energie (' || cast(p_size * 12 + 60 as string) || ' kcal)' || chr(92) || 'Vet' || cast(p_size as string) || 'g' || chr(92)
         || 'Koolhydraten12,5g' || chr(92) || 'waarvan suikers2g' || chr(92) || 'Voedingsvezel3g' || chr(92) || 'Eiwitten4g' || chr(92) || 'Zout0,1g' || chr(92) || 'x' end as nutrients
from part
"""

LISTING = """
select product_id, shop, 'http://shop' || cast(shop as string) || '.example/p/' || cast(product_id as string) as href,
  trim(title) as name_only, trim(substr(text, length(title) + 1)) as ingredients,
  cast(n_chars % 900 + 100 as double) / 1000 as quantity, 'kg' as unit,
  cast(n_chars + 99 as double) / 100 as price, n_chars % 7 = 0 as own_brand
from (
  select doc_id as product_id, doc_id % 2 as shop, text, n_chars, regexp_extract(text, '^[^.!?' || chr(10) || ']*[.!?]*', 0) as title
  from documents) t
"""

SCORED = """
select l.doc_id, l.quality as label, cast(d.n_chars % 1000 as double) / 1000 as score
from labels l join documents d on l.doc_id = d.doc_id
"""

# The same with unknown scores.
SCORED_GAPS = """
select l.doc_id, l.quality as label, case when l.doc_id % 7 = 3 then null else cast(d.n_chars % 1000 as double) / 1000 end as score
from labels l join documents d on l.doc_id = d.doc_id
"""

# A stored shop: a start page with departments, a page per department and one per brand, all with links to leave out.
SITE = """
select 'http://shop0.example/' as url, string_agg('<a class="department" href="/c/' || p_type || '/">x</a>', '') || '<a href="/c/plain/">y</a>' as html
from (select distinct p_type from part) t
union all
select 'http://shop0.example/c/' || p_type || '/',
  '<ul>' || string_agg('<li><a href="/c/' || p_type || '/' || brand || '/">x</a></li>', '') || '<li><a href="/help/">y</a></li></ul><a href="/c/' || p_type || '/loose/">z</a>'
from (select distinct p_type, replace(p_brand, '#', '') as brand from part) t group by p_type
union all
select 'http://shop0.example/c/' || p_type || '/' || brand || '/',
  string_agg('<article><a class="top link" href="/c/' || p_type || '/' || brand || '/' || cast(p_partkey as string) || '">x</a><a href="/c/' || p_type || '/' || brand || '/note">y</a></article>', '')
from (select p_type, replace(p_brand, '#', '') as brand, p_partkey from part) t group by p_type, brand
"""

# A product page per part, in the markup the page functions read; a heading and a price of something else stand outside.
PRODUCT_PAGES = """
select p_partkey, 'http://shop0.example/' || p_type || '/' || replace(p_brand, '#', '') || '/' || cast(p_partkey as string) as url,
  replace(p_brand, '#', '') as sub_cat,
  '<html><body><h1>Menu</h1><article><div class="title"><h1> ' || p_name || ' &amp; co </h1></div><p class="subtitle">' || cast(p_size as string) || ' gram</p>'
  || case p_partkey % 13 when 0 then '' else '<div class="price"><span class="price-large">' || cast(p_size as string) || '</span>'
    || case p_partkey % 5 when 0 then '' else '<span class="price-small">' || cast(10 + p_partkey % 90 as string) || '</span>' end || '</div>' end
  || '</article><div class="tile"><span class="price-small">49</span></div>'
  || case p_partkey % 4 when 0 then '' else '<article><div class="title"><h3>Ingrediënten</h3></div><div class="body">'
    || case p_partkey % 3 when 0 then '' else '<p>Ingrediënten: <b>' || p_type || '</b>, zout</p>' end || '</div></article>' end
  || case p_partkey % 6 when 0 then '' else '<ul class="nutrition"><div class="nutrition-item"><span>Energie kcal</span><span>' || cast(p_size * 8 as string)
    || '</span></div><div class="nutrition-item"><span>Vetten</span></div><div class="nutrition-item"><span>Vet</span><span>' || cast(p_size % 5 as string) || '.5'
    || '</span></div><div class="nutrition-item"><span>Koolhydraten</span><span>' || cast(p_size % 11 as string) || '</span></div><div class="nutrition-item"><span>Zout</span><span>0.' || cast(p_size % 4 as string)
    || '</span></div><div class="nutrition-item"><span>waarvan onverzadigd Vet</span><span>' || cast(p_size % 3 as string)
    || '</span></div><div class="nutrition-item"><span>Eiwitten</span><span>' || case p_partkey % 17 when 0 then 'spoor' else cast(p_size % 6 as string) end || '</span></div></ul>' end
  || '</body></html>' as html
from part
"""

VIEWS = {"raw_a": RAW_A, "raw_b": RAW_B, "listing": LISTING, "scored": SCORED, "scored_gaps": SCORED_GAPS, "site": SITE, "product_pages": PRODUCT_PAGES}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of ``VIEWS`` over the tables of ``folder``."""
    for base in ("part", "documents", "labels"):
        rows = table(spark, folder, base)
        if name == "product_pages" and base == "part":  # a page is a hundred times its short row: one split has very many
            rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        rows.createOrReplaceTempView(base)
    return spark.sql(VIEWS[name])
