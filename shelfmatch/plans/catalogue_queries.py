"""Queries on raw listings: scans, cleaning and row features."""

from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import features, nutrition, text, units
from shelfmatch.operators import cleaning, ordered
from shelfmatch.plans.registry import query
from shelfmatch.plans.views import table, view
from shelfmatch.operators.embedding import HashedTokens
from shelfmatch.sources import catalogues, incremental, vector_store
from shelfmatch.sources.staging import fresh_path

PRICE_COLUMN = "price_2026_03_14"

# --- SQL fragments shared by the checks ---

# Unit words as in the constants, stated again so that the check does not share them.
UNITS = "kg|kilo|g|gr|gram|ml|liter|l|stuk|stuks|st\\.?|pak|pakket|bos|cups?|zakjes?"
SIZE = f"([0-9]+(?:[.,][0-9]+)?)\\s*({UNITS})"
TRAILING = f"\\s*(?:[0-9]+(?:[.,][0-9]+)?\\s*(?:{UNITS})|[0-9]+\\s*-?\\s*pack)\\s*$"
MULTI = "([0-9]+)\\s*x\\s*([0-9]+(?:[.,][0-9]+)?)\\s*([a-zA-Z]+)"
SYNONYMS = " ".join(f"when '{k}' then '{v}'" for k, v in K.UNIT_SYNONYMS.items())


def _mapped(unit):
    return f"case {unit} {SYNONYMS} else {unit} end"


CLEAN_A = (
    ("sized_a", f"""
select *, {_mapped("word")} as unit0,
  cast(replace(nullif(regexp_extract(lower(portion), '{SIZE}', 1), ''), ',', '.') as double) as amount,
  regexp_matches(portion, '{MULTI}') as multi,
  regexp_replace(name, '{TRAILING}', '', 'i') as name_only
from (select *, nullif(regexp_extract(lower(portion), '{SIZE}', 2), '') as word from raw_a
      where contains(href, 'http') and contains(portion, ' ')) r"""),
    ("clean_a", f"""
select p_partkey, href, sub_cat, name, name_only, portion, ingredients, try_cast(price as double) as price,
  try_cast(kcal as double) as kcal, try_cast(carbs_g as double) as carbs_g, try_cast(fat_g as double) as fat_g,
  try_cast(protein_g as double) as protein_g, try_cast(salt_g as double) as salt_g,
  case unit0 when 'g' then 'kg' when 'ml' then 'l' else unit0 end as unit,
  case when multi then cast(regexp_extract(portion, '{MULTI}', 1) as double)
      * cast(replace(regexp_extract(portion, '{MULTI}', 2), ',', '.') as double)
      * case lower(regexp_extract(portion, '{MULTI}', 3)) when 'ml' then 1/1000 when 'cl' then 1/100 when 'g' then 1/1000
          when 'gram' then 1/1000 when 'gr' then 1/1000 else 1.0::double end
    when unit0 in ('g', 'ml') then amount / 1000 else amount end as quantity
from sized_a"""),
)

FEATURES_A = CLEAN_A + (
    ("features_a", """
select *, price / nullif(quantity, 0) as price_per_unit,
  not coalesce(regexp_matches(split_part(ingredients, 'Allergenen:', 1), 'kip|rund|varken|lam|vlees|VIS'), false) as veggie,
  not (coalesce(regexp_matches(split_part(ingredients, 'Allergenen:', 1),
      '(?i)kip|rund|varken|lam|vlees|vis|melk|boter|yoghurt|room|honing|wei|eigeel|eipoeder'), false)
    or coalesce(regexp_matches(split_part(ingredients, 'Allergenen:', 1), '\\bEI\\b'), false)) as vegan,
  contains(lower(name), '1 de beste') as own_brand,
  case when unit in ('kg', 'l') then protein_g * quantity * 10 end as protein_total_g,
  case when unit in ('kg', 'l') then protein_g * quantity * 10 end / nullif(price, 0) as protein_per_euro,
  carbs_g * 4 / nullif(kcal, 0) as frac_kcal_carbs, fat_g * 9 / nullif(kcal, 0) as frac_kcal_fat,
  protein_g * 4 / nullif(kcal, 0) as frac_kcal_protein
from clean_a"""),
)


def _nutrient(label):
    found = f"list_filter(entries, lambda e: regexp_extract(e, '^(.+?)([0-9.,]+)$', 1) = '{label}')[-1]"
    return f"try_cast(replace(regexp_extract({found}, '^(.+?)([0-9.,]+)$', 2), ',', '.') as double)"


CLEAN_B = (
    ("split_b", """
select *, string_split(nutrients, chr(92)) as parts,
  string_split(array_to_string(string_split(nutrients, chr(92))[3:], chr(92)), 'g' || chr(92)) as pieces
from raw_b where nutrients is not null"""),
    ("clean_b", f"""
select p_partkey, name, regexp_replace(name, '{TRAILING}', '', 'i') as name_only, price, ingredients, labels,
  quantity / case unit0 when 'g' then 1000 when 'ml' then 1000 when 'cl' then 100 else 1 end as quantity,
  case unit0 when 'g' then 'kg' when 'ml' then 'l' when 'cl' then 'l' else unit0 end as unit,
  try_cast(nullif(regexp_extract(parts[2], '([0-9]+)\\s*kcal', 1), '') as double) as kcal,
  {_nutrient('Koolhydraten')} as carbs_g, {_nutrient('Vet')} as fat_g, {_nutrient('Eiwitten')} as protein_g,
  {_nutrient('Zout')} as salt_g, {_nutrient('waarvan verzadigd')} as saturated_fat_g,
  {_nutrient('waarvan suikers')} as sugars_g, {_nutrient('Voedingsvezel')} as fiber_g
from (select *, prod_desc as name, {PRICE_COLUMN} as price, quantity_value as quantity, {_mapped("quantity_unit")} as unit0,
    list_transform(pieces[:len(pieces) - 1], lambda p: trim(p)) as entries from split_b) s"""),
)

B_COLUMNS = ("kcal", "carbs_g", "fat_g", "protein_g", "salt_g", "saturated_fat_g", "sugars_g", "fiber_g")


def clean_a(spark, folder):
    return cleaning.clean_text_catalogue(view(spark, folder, "raw_a"))


def features_a(spark, folder):
    return cleaning.add_features(clean_a(spark, folder), "a")


def clean_b(spark, folder):
    return cleaning.clean_field_catalogue(view(spark, folder, "raw_b"), PRICE_COLUMN)


def features_b(spark, folder):
    return cleaning.add_features(clean_b(spark, folder), "b")


def rounded(column, digits=6):
    return F.round(F.col(column), digits).alias(column)


# --- sources ---


@query("scan_project", "select p_partkey, p_name, p_retailprice from part where p_retailprice > 950")
def scan_project(spark, folder):
    return table(spark, folder, "part").where(F.col("p_retailprice") > 950).select("p_partkey", "p_name", "p_retailprice")


def elements(vectors):
    """One row per element of each vector."""
    placed = vectors.select("product_id", F.posexplode("embedding").alias("place", "value"))
    return placed.select("product_id", F.col("place").cast("bigint").alias("place"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query("embedding_scan", "select vec_id as product_id, unnest(range(len(embedding))) as place, "
       "round(cast(unnest(embedding) as double), 6) as value from embeddings")
def embedding_scan(spark, folder):
    return elements(table(spark, folder, "embeddings").withColumnRenamed("vec_id", "product_id"))


@query("embedding_store", """
select d.doc_id as product_id, unnest(range(len(embedding))) as place, round(cast(unnest(embedding) as double), 6) as value
from documents d join embeddings e on d.doc_id = e.vec_id where d.lang = 'en'""")
def embedding_store(spark, folder):
    """Vectors written per shop (here: language) and read back for one."""
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    vectors = table(spark, folder, "embeddings")
    products = docs.join(vectors, F.col("doc_id") == F.col("vec_id")).select(
        F.col("lang").alias("shop"), F.col("doc_id").alias("product_id"), "embedding"
    )
    path = fresh_path(spark, "vectors")
    catalogues.write_vectors(products, path)
    return elements(catalogues.read_vectors(spark, path, "en"))


@query("vector_store_runs", """
select 1 as run, count(distinct coalesce(name_only, '')) as n_vectors from listing where shop = 0
union all select 2, count(distinct coalesce(name_only, '')) from listing where shop = 0
union all select 3, count(distinct coalesce(name_only, '')) from listing""", ("listing",))
def vector_store_runs(spark, folder):
    """Vectors in the store after a run over one shop, the same run again, and one over both shops."""
    path, names = fresh_path(spark, "vector-store"), view(spark, folder, "listing").select("shop", "name_only")
    counts = None
    for run, shops in ((1, [0]), (2, [0]), (3, [0, 1])):
        vector_store.add_missing(names.where(F.col("shop").isin(shops)), path, "hashed-tokens-64", HashedTokens, "name_only")
        stored = spark.read.parquet(f"{path}/*").agg(F.count(F.lit(1)).alias("n_vectors")).first()["n_vectors"]
        row = spark.range(1).select(F.lit(run).alias("run"), F.lit(stored).cast("long").alias("n_vectors"))
        counts = row if counts is None else counts.unionAll(row)
    return counts


@query("csv_round_trip", "select p_partkey, p_name || ', \"' || p_type || '\"' as name, "
       "case when p_partkey % 3 < 2 then round(p_retailprice, 2) end as price, p_size as size, cast(null as varchar) as note from part")
def csv_round_trip(spark, folder):
    """Written as CSV files of two column orders and a file of fewer columns, read back by name; one column is in none."""
    parts = table(spark, folder, "part").select(
        "p_size", F.round("p_retailprice", 2).alias("price"), F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')).alias("name"), "p_partkey"
    ).withColumnRenamed("p_size", "size")
    path = fresh_path(spark, "csv")
    for _ in range(2):  # the second write replaces the first
        catalogues.write_csv(parts.where("p_partkey % 3 = 0"), f"{path}/first")
    catalogues.write_csv(parts.where("p_partkey % 3 = 1").select("name", "p_partkey", "price", "size"), f"{path}/second")
    catalogues.write_csv(parts.where("p_partkey % 3 = 2").select("p_partkey", "size", "name"), f"{path}/third")
    kind = parts.schema["size"].dataType.simpleString()
    return catalogues.read_csv(spark, f"{path}/*", f"p_partkey bigint, name string, price double, size {kind}, note string")


@query("append_round_trip", "select p_partkey, p_brand from part union all select p_partkey, p_brand from part where p_size > 20")
def append_round_trip(spark, folder):
    """Replaced once, then appended to."""
    parts, path = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size"), fresh_path(spark, "appended")
    catalogues.write_table(parts.limit(5), path)
    catalogues.write_table(parts, path)
    catalogues.append_table(parts.where("p_size > 20"), path)
    return spark.read.parquet(path).select("p_partkey", "p_brand")


@query("shop_partition_prune", "select doc_id as product_id, n_chars from documents where lang = 'en'")
def shop_partition_prune(spark, folder):
    """One folder per shop (here: language): a read of one shop opens that folder only."""
    docs = table(spark, folder, "documents").select(
        F.col("lang").alias("shop"), F.col("doc_id").alias("product_id"), "n_chars"
    )
    path = fresh_path(spark, "products")
    catalogues.write_table(docs, path, by="shop")
    return catalogues.read_shop(spark, path, "en").select("product_id", "n_chars")


@query("resume_anti_join",
       "select p_partkey, p_brand from part where p_brand not in (select p_brand from part where p_retailprice < 900.05)")
def resume_anti_join(spark, folder):
    """Products of the brands that no earlier load (here: parts below 900.05) has touched."""
    parts = table(spark, folder, "part")
    return incremental.remaining(parts, parts.where(F.col("p_retailprice") < 900.05), "p_brand").select("p_partkey", "p_brand")


@query("group_sizes", "select p_brand as sub_cat, count(*) as n_products from part group by p_brand")
def group_sizes(spark, folder):
    return incremental.group_sizes(table(spark, folder, "part").select(F.col("p_brand").alias("sub_cat")))


# --- cleaning ---


@query("filter_href", "select p_partkey, href from raw_a where contains(href, 'http')", ("raw_a",))
def filter_href(spark, folder):
    return cleaning.with_link(view(spark, folder, "raw_a")).select("p_partkey", "href")


@query("filter_portion", "select p_partkey, portion from raw_a where contains(portion, ' ')", ("raw_a",))
def filter_portion(spark, folder):
    return cleaning.with_portion(view(spark, folder, "raw_a")).select("p_partkey", "portion")


@query("project_rename",
       f"select p_partkey, prod_desc as name, {PRICE_COLUMN} as price, quantity_value as quantity, "
       "quantity_unit as unit, ingredients, labels, nutrients from raw_b", ("raw_b",))
def project_rename(spark, folder):
    return cleaning.project_fields(view(spark, folder, "raw_b"), PRICE_COLUMN)


@query("drop_null_nutrients", "select p_partkey, nutrients from raw_b where nutrients is not null", ("raw_b",))
def drop_null_nutrients(spark, folder):
    return view(spark, folder, "raw_b").na.drop(subset=["nutrients"]).select("p_partkey", "nutrients")


@query("name_only", f"""
select p_partkey, 'a' as shop, regexp_replace(name, '{TRAILING}', '', 'i') as name_only from raw_a
union all select p_partkey, 'b', regexp_replace(prod_desc, '{TRAILING}', '', 'i') from raw_b""", ("raw_a", "raw_b"))
def name_only(spark, folder):
    def named(source, column, shop):
        name = units.name_without_size(F.col(column)).alias("name_only")
        return view(spark, folder, source).select("p_partkey", F.lit(shop).alias("shop"), name)

    return named("raw_a", "name", "a").unionByName(named("raw_b", "prod_desc", "b"))


@query("qty_unit_extract", f"""
select p_partkey, cast(replace(nullif(regexp_extract(lower(portion), '{SIZE}', 1), ''), ',', '.') as double) as quantity,
  nullif(regexp_extract(lower(portion), '{SIZE}', 2), '') as unit from raw_a""", ("raw_a",))
def qty_unit_extract(spark, folder):
    portion = F.col("portion")
    return view(spark, folder, "raw_a").select(
        "p_partkey", units.quantity(portion).alias("quantity"), units.unit_word(portion).alias("unit")
    )


@query("unit_map", f"select p_partkey, {_mapped('quantity_unit')} as unit from raw_b", ("raw_b",))
def unit_map(spark, folder):
    return view(spark, folder, "raw_b").select("p_partkey", units.canonical_unit(F.col("quantity_unit")).alias("unit"))


@query("unit_scale_a", f"""
select p_partkey, round(case when unit0 in ('g', 'ml') then amount / 1000 else amount end, 6) as quantity,
  case unit0 when 'g' then 'kg' when 'ml' then 'l' else unit0 end as unit from sized_a""", ("raw_a",), CLEAN_A[:1])
def unit_scale_a(spark, folder):
    rows = cleaning.with_portion(cleaning.with_link(view(spark, folder, "raw_a")))
    unit = units.unit_word(F.col("portion"))
    amount = units.base_quantity(units.quantity(F.col("portion")), unit, K.BASE_UNITS_TEXT)
    return rows.select("p_partkey", F.round(amount, 6).alias("quantity"), units.base_unit(unit, K.BASE_UNITS_TEXT).alias("unit"))


@query("unit_scale_b", "select p_partkey, round(quantity, 6) as quantity, unit from clean_b", ("raw_b",), CLEAN_B)
def unit_scale_b(spark, folder):
    return clean_b(spark, folder).select("p_partkey", rounded("quantity"), "unit")


@query("multipack_qty", "select p_partkey, portion, round(quantity, 6) as quantity, unit from clean_a", ("raw_a",), CLEAN_A)
def multipack_qty(spark, folder):
    return clean_a(spark, folder).select("p_partkey", "portion", rounded("quantity"), "unit")


@query("cast_numeric", "select p_partkey, price, kcal, round(quantity, 6) as quantity, carbs_g, fat_g, protein_g, salt_g "
       "from clean_a", ("raw_a",), CLEAN_A)
def cast_numeric(spark, folder):
    return clean_a(spark, folder).select(
        "p_partkey", "price", "kcal", rounded("quantity"), "carbs_g", "fat_g", "protein_g", "salt_g"
    )


@query("unreadable_numbers", "select " + ", ".join(
    f"count(*) filter (where {c} is not null and try_cast({c} as double) is null) as {c}"
    for c in ("price", "kcal", "carbs_g", "fat_g", "protein_g", "salt_g")) + " from raw_a", ("raw_a",))
def unreadable_numbers(spark, folder):
    return cleaning.unreadable_numbers(view(spark, folder, "raw_a"))


def _nutrient_text(label):
    found = f"list_filter(entries, lambda e: regexp_extract(e, '^(.+?)([0-9.,]+)$', 1) = '{label}')[-1]"
    return f"nullif(regexp_extract({found}, '^(.+?)([0-9.,]+)$', 2), '')"


# Labels of the nutrient text as in the constants, stated again so that the check does not share them.
NUTRIENT_TEXTS = (("nutrient_texts", "select nullif(regexp_extract(parts[2], '([0-9]+)\\s*kcal', 1), '') as kcal, " + ", ".join(
    f"{_nutrient_text(label)} as {name}" for label, name in (
        ("Koolhydraten", "carbs_g"), ("Vet", "fat_g"), ("Eiwitten", "protein_g"), ("Zout", "salt_g"),
        ("waarvan verzadigd", "saturated_fat_g"), ("waarvan suikers", "sugars_g"), ("Voedingsvezel", "fiber_g"))
) + " from (select *, list_transform(pieces[:len(pieces) - 1], lambda p: trim(p)) as entries from split_b) s"),)


@query("nutrient_problems", " union all ".join(
    f"""select '{c}' as "column", 'missing' as reason, count(*) filter (where {c} is null) as n_values from nutrient_texts
union all select '{c}', 'no number', count(*) filter (where {c} is not null and try_cast(replace({c}, ',', '.') as double) is null) from nutrient_texts"""
    for c in B_COLUMNS), ("raw_b",), CLEAN_B[:1] + NUTRIENT_TEXTS)
def nutrient_problems(spark, folder):
    """Why values of the shop with nutrient texts are null."""
    return cleaning.nutrient_problems(view(spark, folder, "raw_b"))


@query("parse_nutrients", f"select p_partkey, {', '.join(B_COLUMNS)} from clean_b", ("raw_b",), CLEAN_B)
def parse_nutrients(spark, folder):
    rows = view(spark, folder, "raw_b").na.drop(subset=["nutrients"])
    return rows.select("p_partkey", nutrition.from_text(F.col("nutrients")).alias("values")).select("p_partkey", "values.*")


@query("clean_text_catalogue", "select p_partkey, href, sub_cat, name, name_only, portion, price, round(quantity, 6) as quantity, "
       "unit, kcal, salt_g from clean_a", ("raw_a",), CLEAN_A)
def clean_text_catalogue(spark, folder):
    return clean_a(spark, folder).select(
        "p_partkey", "href", "sub_cat", "name", "name_only", "portion", "price", rounded("quantity"), "unit", "kcal", "salt_g"
    )


@query("clean_field_catalogue", f"select p_partkey, name, name_only, price, round(quantity, 6) as quantity, unit, "
       f"ingredients, labels, {', '.join(B_COLUMNS)} from clean_b", ("raw_b",), CLEAN_B)
def clean_field_catalogue(spark, folder):
    return clean_b(spark, folder).select(
        "p_partkey", "name", "name_only", "price", rounded("quantity"), "unit", "ingredients", "labels", *B_COLUMNS
    )


# --- row features ---


@query("price_per_unit", "select p_partkey, round(price_per_unit, 6) as price_per_unit from features_a", ("raw_a",), FEATURES_A)
def price_per_unit(spark, folder):
    return features_a(spark, folder).select("p_partkey", rounded("price_per_unit"))


@query("strip_allergens", "select p_partkey, split_part(ingredients, 'Allergenen:', 1) as ingredients from raw_a", ("raw_a",))
def strip_allergens(spark, folder):
    return view(spark, folder, "raw_a").select("p_partkey", features.without_allergens(F.col("ingredients")).alias("ingredients"))


@query("veggie_flag", "select p_partkey, veggie from features_a", ("raw_a",), FEATURES_A)
def veggie_flag(spark, folder):
    return features_a(spark, folder).select("p_partkey", "veggie")


@query("vegan_flag", "select p_partkey, vegan from features_a", ("raw_a",), FEATURES_A)
def vegan_flag(spark, folder):
    return features_a(spark, folder).select("p_partkey", "vegan")


@query("own_brand", """
select p_partkey, 'a' as shop, contains(lower(name), '1 de beste') as own_brand from raw_a
union all
select p_partkey, 'b', regexp_matches(lower(prod_desc), 'ah|perla|delicata|de zaanse hoeve|zaanlander|brouwers')
from raw_b""", ("raw_a", "raw_b"))
def own_brand(spark, folder):
    a = view(spark, folder, "raw_a").select(
        "p_partkey", F.lit("a").alias("shop"), features.is_own_brand(F.col("name"), "a").alias("own_brand")
    )
    b = view(spark, folder, "raw_b").select(
        "p_partkey", F.lit("b").alias("shop"), features.is_own_brand(F.col("prod_desc"), "b").alias("own_brand")
    )
    return a.unionByName(b)


@query("protein_value", "select p_partkey, round(protein_total_g, 6) as protein_total_g, "
       "round(protein_per_euro, 6) as protein_per_euro from features_a", ("raw_a",), FEATURES_A)
def protein_value(spark, folder):
    return features_a(spark, folder).select("p_partkey", rounded("protein_total_g"), rounded("protein_per_euro"))


SHARES = ("frac_kcal_carbs", "frac_kcal_fat", "frac_kcal_protein")


@query("macro_share", "select p_partkey, " + ", ".join(f"round({c}, 6) as {c}" for c in SHARES) + " from features_a",
       ("raw_a",), FEATURES_A)
def macro_share(spark, folder):
    return features_a(spark, folder).select("p_partkey", *[rounded(c) for c in SHARES])


@query("dense_id", "select p_partkey, row_number() over (order by p_name, p_partkey) - 1 as product_id from part")
def dense_id(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return ordered.with_position(parts, ["p_name", "p_partkey"], "product_id").select("p_partkey", "product_id")


@query("embed_text", """
select p_partkey, 'Name: ' || name || '; Quantity: ' || coalesce(cast(quantity as varchar), '') || coalesce(unit, '')
  || '; Ingredients: ' || coalesce(ingredients, '') as product_text from clean_b""", ("raw_b",), CLEAN_B)
def embed_text(spark, folder):
    columns = (F.col(c) for c in ("name", "quantity", "unit", "ingredients"))
    return clean_b(spark, folder).select("p_partkey", text.product_text(*columns).alias("product_text"))
