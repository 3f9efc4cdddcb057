"""Queries that evaluate the score, sample labels, compare prices and explore products."""

from functools import reduce

from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import features
from shelfmatch.operators import eda, evaluation, labels, prices
from shelfmatch.plans import matching as plan
from shelfmatch.plans.catalogue_queries import CLEAN_B, FEATURES_A, PRICE_COLUMN, features_a, features_b
from shelfmatch.plans.match_queries import BEST, rounded
from shelfmatch.plans.registry import query
from shelfmatch.plans.views import table, view
from shelfmatch.sources import label_store
from shelfmatch.sources.staging import fresh_path

# --- labels and evaluation ---


def scored(spark, folder):
    return view(spark, folder, "scored")


COUNTS = (("counts", "select score, cast(sum(label) as bigint) as p, count(*) - cast(sum(label) as bigint) as n, count(*) as m "
           "from scored where label is not null group by score"),)
CURVE = COUNTS + (("curve", """
select score, sum(p) over w / sum(m) over w as precision, sum(p) over w / (select sum(p) from counts) as recall
from counts window w as (order by score desc)"""),)
SWEEP = (("sweep", """
select step, threshold, case when tp + fp > 0 then tp / (tp + fp) else 0 end as precision,
  case when tp + fn > 0 then tp / (tp + fn) else 0 end as recall, case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end as f1
from (select step, threshold, count(*) filter (where score >= threshold and label = 1) as tp,
    count(*) filter (where score >= threshold and label = 0) as fp, count(*) filter (where score < threshold and label = 1) as fn
  from scored, (select cast(unnest(range(100)) as integer) as step, step * 0.01::double as threshold) t group by step, threshold) c"""),)
SWEEP_SQL = "select step, round(threshold, 6) as threshold, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from sweep"
SWEEP_COLUMNS = ("threshold", "precision", "recall", "f1")


@query("natural_join", "select doc_id, quality, toxic, lang, source, n_chars, md5(text) as text_md5 from labels join documents using (doc_id) where quality is not null")
def natural_join(spark, folder):
    """Labels and documents on their common column, unlabelled rows dropped."""
    joined = evaluation.natural_join(table(spark, folder, "labels"), table(spark, folder, "documents"))
    return joined.na.drop(subset=["quality"]).select("doc_id", "quality", "toxic", "lang", "source", "n_chars", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("roc_auc", "select round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) as roc_auc from "
       "(select p, n, coalesce(sum(n) over (order by score rows between unbounded preceding and 1 preceding), 0) as below from counts) t",
       ("scored",), COUNTS)
def roc_auc(spark, folder):
    return evaluation.roc_auc(scored(spark, folder)).select(*rounded("roc_auc"))


@query("pr_curve", "select score, round(precision, 6) as precision, round(recall, 6) as recall from curve union all select null, 1.0, 0.0",
       ("scored",), CURVE)
def pr_curve(spark, folder):
    return evaluation.pr_curve(scored(spark, folder)).select("score", *rounded("precision", "recall"))


@query("pr_auc", "select round(sum((recall - r0) * (precision + p0) / 2), 6) as pr_auc from (select recall, precision, "
       "lag(recall, 1, 0) over (order by score desc) as r0, lag(precision, 1, 1) over (order by score desc) as p0 from curve) t",
       ("scored",), CURVE)
def pr_auc(spark, folder):
    return evaluation.pr_auc(scored(spark, folder)).select(*rounded("pr_auc"))


@query("threshold_sweep", SWEEP_SQL, ("scored",), SWEEP)
def threshold_sweep(spark, folder):
    return evaluation.threshold_sweep(scored(spark, folder)).select("step", *rounded(*SWEEP_COLUMNS))


@query("best_threshold", f"{SWEEP_SQL} order by sweep.f1 desc, step limit 1", ("scored",), SWEEP)
def best_threshold(spark, folder):
    return evaluation.best_threshold(evaluation.threshold_sweep(scored(spark, folder))).select("step", *rounded(*SWEEP_COLUMNS))


@query("sweep_tail", f"{SWEEP_SQL} where step >= 60", ("scored",), SWEEP)
def sweep_tail(spark, folder):
    return evaluation.sweep_tail(evaluation.threshold_sweep(scored(spark, folder))).select("step", *rounded(*SWEEP_COLUMNS))


@query("confusion_at", """
select tp, fp, fn, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1
from (select count(*) filter (where score >= 0.78::double and label = 1) as tp, count(*) filter (where score >= 0.78::double and label = 0) as fp,
  count(*) filter (where score < 0.78::double and label = 1) as fn from scored) c""", ("scored",))
def confusion_at(spark, folder):
    found = evaluation.confusion_at(scored(spark, folder), K.MATCH_THRESHOLD)
    return found.select("tp", "fp", "fn", *rounded("precision", "recall", "f1"))


@query("confusion_with_gaps", """
select tp, fp, fn, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1
from (select count(*) filter (where hit and label = 1) as tp, count(*) filter (where hit and label = 0) as fp,
  count(*) filter (where not hit and label = 1) as fn from (select label, coalesce(score >= 0.78::double, false) as hit from scored_gaps) s) c""", ("scored_gaps",))
def confusion_with_gaps(spark, folder):
    """A pair without a score is not predicted."""
    found = evaluation.confusion_at(view(spark, folder, "scored_gaps"), K.MATCH_THRESHOLD)
    return found.select("tp", "fp", "fn", *rounded("precision", "recall", "f1"))


@query("sweep_with_gaps", SWEEP_SQL, ("scored_gaps",), (("scored", "select doc_id, label, coalesce(score, -1) as score from scored_gaps"),) + SWEEP)
def sweep_with_gaps(spark, folder):
    return evaluation.threshold_sweep(view(spark, folder, "scored_gaps")).select("step", *rounded(*SWEEP_COLUMNS))


def strata(source, key, tag, draws=(150, 300, 150)):
    """Thirds by position and the draws of each: lowest md5 of key and seed."""
    return ((f"{tag}strata", f"""
select *, case when position < n // 3 then 'high' when position < 2 * n // 3 then 'middle' else 'low' end as stratum
from (select *, row_number() over (order by score desc, {', '.join(key)}) - 1 as position, count(*) over () as n from {source}) r"""),
        (f"{tag}sample", f"""
select * from (select *, row_number() over (partition by stratum order by draw_hash) as turn
  from (select *, md5({" || '|' || ".join(f'cast({k} as varchar)' for k in key)} || '|42') as draw_hash from {tag}strata) h) t
where turn <= case stratum when 'high' then {draws[0]} when 'middle' then {draws[1]} else {draws[2]} end"""))


@query("stratified_sample", "select doc_id, score, stratum from sample", ("scored",), strata("scored", ("doc_id",), ""))
def stratified_sample(spark, folder):
    return labels.stratified_sample(scored(spark, folder), ["doc_id"]).select("doc_id", "score", "stratum")


@query("stratified_draw", "select doc_id, score, stratum from sample", ("scored",), strata("scored", ("doc_id",), "", (9, 12, 6)))
def stratified_draw(spark, folder):
    """Fewer draws than a third has rows, at every size of the tables."""
    return labels.stratified_sample(scored(spark, folder), ["doc_id"], draws=(9, 12, 6)).select("doc_id", "score", "stratum")


@query("attach_labels", "select d.doc_id, n_chars, quality as label from documents d left join labels l on d.doc_id = l.doc_id")
def attach_labels(spark, folder):
    pairs = table(spark, folder, "documents").select("doc_id", "n_chars")
    given = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return labels.attach_labels(pairs, given, ["doc_id"])


@query("label_upsert", """
select coalesce(l.doc_id, u.doc_id) as doc_id, case when u.doc_id is not null then u.label else l.quality end as label
from labels l full join (select doc_id, cast(case when n_chars > 2000 then 1 else 0 end as integer) as label from documents where lang <> 'en') u
  on l.doc_id = u.doc_id""")
def label_upsert(spark, folder):
    """Labels after a second pass over the documents that are not English: a first verdict for all, a later one for some."""
    given = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, folder, "documents").where(F.col("lang") != "en").select("doc_id", "n_chars")
    long = F.col("n_chars") > 2000
    first = docs.select("doc_id", F.lit(0).alias("label"), F.lit(1).cast("bigint").alias("version"))
    second = docs.where(long).select("doc_id", F.lit(1).alias("label"), F.lit(2).cast("bigint").alias("version"))
    return labels.upsert_labels(given, first.unionByName(second), ["doc_id"])


@query("label_store_versions", """
select 1 as store_version, doc_id, cast(quality as integer) as label from labels
union all
select 2, coalesce(l.doc_id, u.doc_id), case when u.doc_id is not null then u.label else l.quality end
from labels l full join (select doc_id, cast(case when n_chars > 2000 then 1 else 0 end as integer) as label from documents where lang = 'de') u
  on l.doc_id = u.doc_id""")
def label_store_versions(spark, folder):
    """The stored labels before and after the verdicts on the German documents were saved."""
    path = fresh_path(spark, "labels")
    given = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    label_store.create(given, path, ["doc_id"])
    verdict = (F.col("n_chars") > 2000).cast("int").alias("label")
    docs = table(spark, folder, "documents").where(F.col("lang") == "de")
    label_store.update(docs.select("doc_id", verdict, F.lit(1).cast("bigint").alias("version")), path)
    saved = [label_store.read(spark, path, n).select(F.lit(n).alias("store_version"), "doc_id", "label") for n in (1, 2)]
    return saved[0].unionByName(saved[1])


REVIEW_KEY = ("product_id_a", "product_id_b")
REVIEW = BEST + (("matches", "select product_id as product_id_a, * exclude (product_id) from best"),) + strata("matches", REVIEW_KEY, "")
REVIEW_COLUMNS = ("href", "name_only_a", "name_only_b", "quantity_a", "quantity_b", "price_a", "price_b")


@query("review_rows", f"""
select product_id_a, product_id_b, {', '.join(REVIEW_COLUMNS)}, stratum,
  cast(row_number() over (order by case stratum when 'high' then 1 when 'middle' then 2 else 3 end, draw_hash) - 1 as integer) as draw,
  round(cos, 6) as embedding_score, round(fuzz, 6) as name_fuzz_score, round(jacc, 6) as name_jacc_score,
  round(quantity_score, 6) as quantity_score, round(price_score, 6) as price_score, round(score, 6) as score from sample""",
       ("listing",), REVIEW)
def review_rows(spark, folder):
    """What a reviewer sees of each drawn match."""
    matches = plan.staged_matches(plan.listing_sides(spark, folder))
    drawn = labels.stratified_sample(matches.select(*REVIEW_KEY, "score"), list(REVIEW_KEY))
    parts = ("embedding_score", "name_fuzz_score", "name_jacc_score", "quantity_score", "price_score", "score")
    return labels.review_rows(drawn, matches, list(REVIEW_KEY)).select(
        *REVIEW_KEY, *REVIEW_COLUMNS, "stratum", "draw", *rounded(*parts)
    )


# --- prices of matched products ---

MATCHED = BEST + (("diffs", """
select product_id as product_id_a, product_id_b, price_a, price_b, own_brand_a, score, price_b - price_a as abs_price_diff,
  (price_b - price_a) / nullif(greatest(price_a, price_b), 0) as rel_price_diff from best"""),)


def _scopes(sql):
    return sql.format(scope="'Overall'", member="true") + " union all " + sql.format(scope="'Own Brand'", member="own_brand_a")


WINS = MATCHED + (("predicted", "select * from diffs where score > 0.78::double"), ("wins", _scopes("""
select {scope} as scope, count(*) filter (where {member} and price_a < price_b) as cheaper_a,
  count(*) filter (where {member} and price_a = price_b) as equal, count(*) filter (where {member} and price_b < price_a) as cheaper_b
from predicted""")))


def predicted(spark, folder):
    return plan.predicted(plan.listing_sides(spark, folder))


@query("price_diff", "select product_id_a, product_id_b, round(abs_price_diff, 6) as abs_price_diff, round(rel_price_diff, 6) as rel_price_diff from diffs",
       ("listing",), MATCHED)
def price_diff(spark, folder):
    matches = prices.with_price_diffs(plan.match(plan.listing_sides(spark, folder)))
    return matches.select("product_id_a", "product_id_b", *rounded("abs_price_diff", "rel_price_diff"))


@query("price_wins", "select cheaper_a, equal, cheaper_b from wins where scope = 'Overall'", ("listing",), WINS)
def price_wins(spark, folder):
    return prices.wins_table(predicted(spark, folder)).where(F.col("scope") == "Overall").drop("scope")


@query("wins_table", "select scope, cheaper_a, equal, cheaper_b from wins", ("listing",), WINS)
def wins_table(spark, folder):
    return prices.wins_table(predicted(spark, folder))


@query("wins_offsets", "select scope, round(-equal / 2, 6) + 0 as left_equal, round(-equal / 2 - cheaper_a, 6) + 0 as left_a, equal / 2 as left_b from wins",
       ("listing",), WINS)
def wins_offsets(spark, folder):
    offsets = prices.wins_offsets(prices.wins_table(predicted(spark, folder)))
    return offsets.select("scope", *[(F.col(c) + 0.0).alias(c) for c in ("left_equal", "left_a", "left_b")])


COMPARISON = _scopes("""
select {scope} as scope, count(*) filter (where {member} and price_a < price_b) as cheaper_a,
  count(*) filter (where {member} and price_a = price_b) as equal, count(*) filter (where {member} and price_b < price_a) as cheaper_b,
  count(*) filter (where {member} and usual) as n_pairs, round(avg(rel_price_diff) filter (where {member} and usual), 6) as mean_rel_diff,
  round(coalesce(sum(price_a) filter (where {member} and usual), 0), 6) as total_a, round(coalesce(sum(price_b) filter (where {member} and usual), 0), 6) as total_b
from (select *, abs(rel_price_diff) < 0.4::double as usual from pairs_to_compare) u""")
VERDICT = """select *, case when mean_rel_diff > 0 then 'shop a is ' || printf('%.1f%%', abs(mean_rel_diff) * 100) || ' cheaper on average'
  else 'shop b is ' || printf('%.1f%%', abs(mean_rel_diff) * 100) || ' cheaper on average' end as verdict from (""" + COMPARISON + ") c"


def compared(report):
    return report.select("scope", "cheaper_a", "equal", "cheaper_b", "n_pairs", *rounded("mean_rel_diff", "total_a", "total_b"), "verdict")


@query("price_comparison", VERDICT.replace("pairs_to_compare", "predicted"), ("listing",), WINS)
def price_comparison(spark, folder):
    return compared(prices.price_comparison(predicted(spark, folder)))


@query("price_comparison_labelled", VERDICT.replace("pairs_to_compare", "correct"), ("listing",),
       MATCHED + (("correct", "select d.* from diffs d join labels l on d.product_id_a = l.doc_id where l.quality = 1"),))
def price_comparison_labelled(spark, folder):
    """The same on pairs a label calls correct; the labels given are per document, here of the product of shop a."""
    given = table(spark, folder, "labels").select(F.col("doc_id").alias("product_id_a"), F.col("quality").alias("label"))
    matches = plan.match(plan.listing_sides(spark, folder))
    checked = prices.correct_pairs(evaluation.labelled(evaluation.natural_join(given, matches)))
    return compared(prices.price_comparison(checked))


def _raw(chain):
    """The chain on products that have units, and may lack sizes, units and ingredients."""
    units = {
        "cast(quantity as varchar) || 'kg; ": "coalesce(cast(quantity as varchar), '') || unit || '; ",
        "price, ingredients": "unit, price, ingredients",
        "l.price = p.price": "l.unit = p.unit and l.price = p.price",
    }
    return tuple((name, reduce(lambda sql, part: sql.replace(*part), units.items(), sql)) for name, sql in chain)


RAW_LISTING = FEATURES_A + CLEAN_B + (("listing", """
select 2 * p_partkey as product_id, 0 as shop, href, name_only, own_brand, round(quantity, 6) as quantity, coalesce(unit, '') as unit,
  price, coalesce(ingredients, '') as ingredients from features_a
union all
select 2 * p_partkey + 1, 1, cast(2 * p_partkey + 1 as varchar), name_only,
  regexp_matches(lower(name), 'ah|perla|delicata|de zaanse hoeve|zaanlander|brouwers'), round(quantity, 6), coalesce(unit, ''), price,
  coalesce(ingredients, '') from clean_b"""),)


@query("raw_price_comparison", VERDICT.replace("pairs_to_compare", "predicted"), ("raw_a", "raw_b"), RAW_LISTING + _raw(WINS))
def raw_price_comparison(spark, folder):
    """Both raw catalogues cleaned, handed over as CSV, matched and compared."""
    raw_a = view(spark, folder, "raw_a").withColumn("product_id", 2 * F.col("p_partkey"))
    raw_b = view(spark, folder, "raw_b").withColumn("product_id", 2 * F.col("p_partkey") + 1)
    return compared(plan.compare_raw(raw_a, raw_b, PRICE_COLUMN, fresh_path(spark, "cleaned")))


# --- exploration ---


@query("valid_products", "select p_partkey, name from features_a where frac_kcal_carbs <= 1.1::double and frac_kcal_fat <= 1.1::double "
       "and frac_kcal_protein <= 1.1::double", ("raw_a",), FEATURES_A)
def valid_products(spark, folder):
    return eda.valid_products(features_a(spark, folder)).select("p_partkey", "name")


@query("price_stats", "select shop, count(*) as n_products, round(avg(price), 6) as mean_price, round(median(price), 6) as median_price "
       "from listing group by shop", ("listing",))
def price_stats(spark, folder):
    stats = eda.price_stats(view(spark, folder, "listing").select("shop", "price"))
    return stats.select("shop", "n_products", *rounded("mean_price", "median_price"))


@query("clip_price", "select p_partkey, least(greatest(price / 70, 0), 15) as price from clean_a", ("raw_a",), FEATURES_A[:2])
def clip_price(spark, folder):
    return features_a(spark, folder).select("p_partkey", eda.clip(F.col("price") / 70).alias("price"))


@query("price_kde", """
select s.shop, cast(point as integer) as point, round(min(low - 3 * h + point * (high + 3 * h - low + 3 * h) / 199), 6) as x,
  round(sum(exp(-pow((low - 3 * h + point * (high + 3 * h - low + 3 * h) / 199 - price) / h, 2) / 2) / (n * h * sqrt(2 * pi()))), 6) as density
from (select shop, count(*) as n, min(price) as low, max(price) as high, stddev_samp(price) * pow(count(*), -0.2) as h from clipped group by shop) s
join clipped c on s.shop = c.shop, (select unnest(range(200)) as point) g group by s.shop, point""", ("listing",),
       (("clipped", "select shop, least(greatest(price, 0), 15) as price from listing"),))
def price_kde(spark, folder):
    density = eda.price_density(view(spark, folder, "listing").select("shop", "price"))
    return density.select("shop", "point", *rounded("x", "density"))


# The reports of shop b, on the products whose macro shares can be right.
VALID_B = CLEAN_B + (("valid_b", """
select p_partkey, name, 'b' as shop, price, protein_g, protein_g * 4 / nullif(kcal, 0) as frac_kcal_protein, vegan from (
  select *, not (coalesce(regexp_matches(ingredients, '(?i)kip|rund|varken|lam|vlees|vis|melk|boter|yoghurt|room|honing|wei|eigeel|eipoeder'), false)
    or coalesce(regexp_matches(ingredients, '\\bEI\\b'), false)) as vegan from clean_b) c
where carbs_g * 4 / nullif(kcal, 0) <= 1.1::double and fat_g * 9 / nullif(kcal, 0) <= 1.1::double and protein_g * 4 / nullif(kcal, 0) <= 1.1::double"""),)


def valid_b(spark, folder):
    return eda.valid_products(features_b(spark, folder))


@query("price_stats_valid", "select shop, count(*) as n_products, round(avg(price), 6) as mean_price, round(median(price), 6) as median_price "
       "from valid_b group by shop", ("raw_b",), VALID_B)
def price_stats_valid(spark, folder):
    stats = eda.price_stats(valid_b(spark, folder).select(F.lit("b").alias("shop"), "price"))
    return stats.select("shop", "n_products", *rounded("mean_price", "median_price"))


@query("top_protein_valid", "select p_partkey, name, round(protein_g, 6) as protein_g from valid_b where protein_g is not null "
       "order by valid_b.protein_g desc, p_partkey limit 5", ("raw_b",), VALID_B)
def top_protein_valid(spark, folder):
    return eda.top_products(valid_b(spark, folder), "protein_g", "p_partkey").select("p_partkey", "name", *rounded("protein_g"))


@query("frac_non_vegan_valid", """
select threshold, round(1 - avg(cast(vegan as integer)) filter (where frac_kcal_protein > threshold), 6) as share_non_vegan
from valid_b, (select unnest([0.0::double, 0.2::double]) as threshold) t group by threshold""", ("raw_b",), VALID_B)
def frac_non_vegan_valid(spark, folder):
    return eda.share_non_vegan(valid_b(spark, folder)).select("threshold", *rounded("share_non_vegan"))


def top_query(name, column):
    @query(name, f"select p_partkey, name, round({column}, 6) as {column} from features_a where {column} is not null "
           f"order by features_a.{column} desc, p_partkey limit 5", ("raw_a",), FEATURES_A)
    def top_of(spark, folder):
        return eda.top_products(features_a(spark, folder), column, "p_partkey").select("p_partkey", "name", *rounded(column))

    return top_of


top_query("top_protein", "protein_g")
top_query("top_protein_euro", "protein_per_euro")


@query("frac_non_vegan", """
select threshold, round(1 - avg(cast(vegan as integer)) filter (where frac_kcal_protein > threshold), 6) as share_non_vegan
from features_a, (select unnest([0.0::double, 0.2::double]) as threshold) t group by threshold""", ("raw_a",), FEATURES_A)
def frac_non_vegan(spark, folder):
    return eda.share_non_vegan(features_a(spark, folder)).select("threshold", *rounded("share_non_vegan"))


DIET = FEATURES_A + (("diets", "select *, case when vegan then 'Vegan' when veggie then 'Veggie' else 'Meats' end as diet from features_a"),)


@query("diet_class", "select p_partkey, diet from diets", ("raw_a",), DIET)
def diet_class(spark, folder):
    diet = features.diet_class(F.col("veggie"), F.col("vegan"))
    return features_a(spark, folder).select("p_partkey", diet.alias("diet"))


@query("affordability_points", "select diet, round(frac_kcal_protein, 6) as x, round(protein_per_euro, 6) as y, name as label "
       "from diets where frac_kcal_protein > 0.2::double", ("raw_a",), DIET)
def affordability_points(spark, folder):
    return eda.affordability_points(features_a(spark, folder)).select("diet", *rounded("x", "y"), "label")


@query("fat_protein_points", "select diet, round(frac_kcal_protein, 6) as x, round(frac_kcal_fat, 6) as y, name as label from diets", ("raw_a",), DIET)
def fat_protein_points(spark, folder):
    return eda.fat_protein_points(features_a(spark, folder)).select("diet", *rounded("x", "y"), "label")


@query("macro_points", "select diet, round(frac_kcal_carbs, 6) as x, round(frac_kcal_fat, 6) as y, round(frac_kcal_protein, 6) as z, "
       "name as label, price, round(protein_per_euro, 6) as protein_per_euro from diets", ("raw_a",), DIET)
def macro_points(spark, folder):
    return eda.macro_points(features_a(spark, folder)).select("diet", *rounded("x", "y", "z"), "label", "price", *rounded("protein_per_euro"))
