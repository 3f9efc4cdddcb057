"""Queries on the two free-text catalogues: corpus statistics, blocks, embeddings, pair scores and matches."""

from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import similarity, text
from shelfmatch.operators import corpus, matching
from shelfmatch.operators.embedding import encode
from shelfmatch.plans import matching as plan
from shelfmatch.plans.registry import query
from shelfmatch.plans.views import table, view
from shelfmatch.sources.staging import stage

# --- SQL fragments shared by the checks ---

STOP = "[" + ", ".join(f"'{w}'" for w in K.STOPWORDS) + "]"
NAMES = (("names", f"""
select *, list_filter(regexp_extract_all(lower(name_only), '[\\p{{L}}\\p{{N}}_]+'), lambda t: not list_contains({STOP}, t)) as toks
from listing"""),)
VOCABULARY = NAMES + (("vocabulary", """
select token, count(*) as df, ln((1 + max(n)) / (1 + count(*))) + 1 as idf
from (select unnest(list_distinct(toks)) as token from names) t, (select cast(count(*) as double) as n from listing) c
group by token having count(*) >= 3 and count(*) <= cast(0.2 as double) * max(n)"""),)
RANKED = VOCABULARY + (("ranked", """
select * from (
  select product_id, token, df, idf, row_number() over (partition by product_id order by df, pos) as rank
  from (select product_id, unnest(toks) as token, generate_subscripts(toks, 1) as pos from names) t join vocabulary using (token)
  where length(token) > 2) r where rank <= 5"""),)
BLOCKS = RANKED + (("blocks", """
select product_id, token as block, rank as place from ranked where rank <= 4
union all
select a.product_id, a.token || '_' || b.token, 10 * a.rank + b.rank
from ranked a join ranked b on a.product_id = b.product_id and a.rank < b.rank"""),)
KEYS = BLOCKS + (("block_rows", """
select l.product_id, shop, case when block is not null then case when own_brand then 'True_' else 'False_' end || block end as block_key
from listing l left join blocks b on l.product_id = b.product_id"""),)
PROFILES = KEYS + (("profiles", """
select min(product_id) as product_id, shop, count(*) as copies, name_only, own_brand, quantity, price, ingredients
from listing group by shop, name_only, own_brand, quantity, price, ingredients"""),)
PAIRS = PROFILES + (("candidates", """
select distinct a.product_id as product_id_a, b.product_id as product_id_b
from (select * from block_rows semi join profiles using (product_id) where shop = 0) a
join (select * from block_rows semi join profiles using (product_id) where shop = 1) b
  on a.block_key is not distinct from b.block_key"""),)

TEXT = "'Name: ' || name_only || '; Quantity: ' || cast(quantity as varchar) || 'kg; Ingredients: ' || ingredients"


def vectors(source):
    """Hashed token counts of the product text, as 64 floats of length one."""
    return (("buckets", f"""
select product_id, cast('0x' || right(md5(t), 2) as integer) % 64 as bucket, count(*) as n
from (select product_id, unnest(regexp_extract_all(lower({TEXT}), '[\\p{{L}}\\p{{N}}_]+')) as t from {source}) w group by 1, 2"""),
        ("vectors", """
select product_id, list(w order by bucket) as vector from (
  select i.product_id, i.bucket, cast(cast(coalesce(n / norm, 0) as float) as double) as w
  from (select product_id, norm, unnest(range(64)) as bucket
    from (select product_id, sqrt(sum(n * n)) as norm from buckets group by 1) s) i
  left join buckets b on i.product_id = b.product_id and i.bucket = b.bucket) x group by product_id"""))


SORTED = "array_to_string(list_sort(list_filter(string_split_regex(name_only, '\\s+'), lambda w: w <> '')), ' ')"
ONES = 2**60 - 1


def common(pairs):
    """Longest common subsequence of sa and sb, in limbs of 60 bits: one list per character of sb, folded over the
    rows of the comparison with a carry from limb to limb."""
    return (("texts", f"select distinct sa, sb from {pairs}"),
        ("bits", """
select sa, ch, list(bit order by limb) as mask from (
  select g.sa, g.ch, g.limb, cast(coalesce(sum(1::hugeint << ((pos - 1) % 60)::integer), 0) as bigint) as bit
  from (select d.sa, ch, unnest(range((length(d.sa) + 59) // 60)) as limb
    from (select distinct sa, unnest(string_split(sa, '')) as ch from texts) d) g
  left join (select sa, unnest(string_split(sa, '')) as ch, unnest(range(1, length(sa) + 1)) as pos from (select distinct sa from texts) e) p
    on g.sa = p.sa and g.ch = p.ch and (pos - 1) // 60 = g.limb
  group by g.sa, g.ch, g.limb) b group by sa, ch"""),
        ("folded", f"""
select sa, sb, list_reduce(list(mask order by pos), lambda v, m: list_reduce(
    list_transform(range(1, len(v) + 1), lambda i: [v[i], v[i] & m[i]]),
    lambda acc, e: list_concat([(e[1] + e[2] + acc[1]) >> 60], acc[2:], [((e[1] + e[2] + acc[1]) & {ONES}) | (e[1] - e[2])]),
    [0::bigint])[2:], list_transform(range((length(sa) + 59) // 60), lambda i: {ONES}::bigint)) as rest
from (select t.sa, t.sb, pos, mask from (select sa, sb, unnest(string_split(sb, '')) as ch, unnest(range(1, length(sb) + 1)) as pos from texts) t
  join bits on t.sa = bits.sa and t.ch = bits.ch) z group by sa, sb"""),
        ("common", """
select t.sa, t.sb, case when length(t.sa) + length(t.sb) = 0 then 1.0::double else 2 * coalesce(length(t.sa) - list_sum(list_transform(range(1, len(rest) + 1),
    lambda i: bit_count(rest[i] & ((1::hugeint << least(60, length(t.sa) - 60 * (i - 1))::integer) - 1)::bigint))), 0)::double
  / (length(t.sa) + length(t.sb)) end as fuzz
from texts t left join folded f on t.sa = f.sa and t.sb = f.sb"""))


PARTS = PAIRS + vectors("profiles") + (("parts", f"""
select c.*, a.copies as copies_a, b.copies as copies_b, a.name_only as name_only_a, b.name_only as name_only_b,
  a.price as price_a, b.price as price_b, a.quantity as quantity_a, b.quantity as quantity_b,
  a.own_brand as own_brand_a, b.own_brand as own_brand_b,
  {SORTED.replace('name_only', 'a.name_only')} as sa, {SORTED.replace('name_only', 'b.name_only')} as sb,
  case when len(list_distinct(na.toks || nb.toks)) > 0
    then len(list_intersect(na.toks, nb.toks)) / len(list_distinct(na.toks || nb.toks)) else 0 end as jacc,
  pow(1 - abs(a.quantity - b.quantity) / nullif(greatest(a.quantity, b.quantity), 0), 2) as quantity_score,
  1 - abs(a.price - b.price) / nullif(greatest(a.price, b.price), 0) as price_score,
  list_inner_product(va.vector, vb.vector) as cos
from candidates c join profiles a on product_id_a = a.product_id join profiles b on product_id_b = b.product_id
join names na on product_id_a = na.product_id join names nb on product_id_b = nb.product_id
join vectors va on product_id_a = va.product_id join vectors vb on product_id_b = vb.product_id"""),)
SCORE = ("round(0.35::double * cos + 0.25::double * fuzz + 0.1::double * jacc + 0.25::double * quantity_score "
         "+ 0.05::double * price_score, 9)")
# Only pairs whose best possible score passes are compared character by character, as in the engine.
SCORED = PARTS + (("open_pairs", """
select * from parts where 0.35 * cos + 0.1 * jacc + 0.25 * quantity_score + 0.05 * price_score
  + 0.25 * case when length(sa) + length(sb) = 0 then 1 else 2 * least(length(sa), length(sb)) / (length(sa) + length(sb)) end > 0.599"""),
) + common("open_pairs") + (("scored_pairs", f"""
select p.*, fuzz, {SCORE} as score from open_pairs p join common using (sa, sb)"""), ("pairs", "select * from scored_pairs where score > 0.6::double"))
BEST = SCORED + (("best", """
select l.product_id, l.href, b.* exclude (product_id_a)
from listing l join profiles p on l.shop = p.shop and l.name_only = p.name_only and l.own_brand = p.own_brand
  and l.quantity = p.quantity and l.price = p.price and l.ingredients = p.ingredients
join (select * from pairs qualify row_number() over (partition by product_id_a order by score desc, product_id_b) = 1) b
  on b.product_id_a = p.product_id"""),)


def listing(spark, folder):
    return view(spark, folder, "listing")


def vocabulary(spark, folder):
    return corpus.vocabulary(listing(spark, folder))


def catalogues(spark, folder, **options):
    return matching.prepare(plan.listing_sides(spark, folder), **options)


def rounded(*columns, digits=6):
    return [F.round(F.col(c), digits).alias(c) for c in columns]


# --- corpus and blocks ---


@query("corpus_union", "select 0 as shop, name_only from listing where shop = 0 union all select 1, name_only from listing where shop = 1",
       ("listing",))
def corpus_union(spark, folder):
    def names(shop):
        rows = listing(spark, folder).where(F.col("shop") == shop)
        return rows.select(F.lit(shop).alias("shop"), "name_only")

    return corpus.union_catalogues(names(0), names(1))


@query("tokenize", "select product_id, array_to_string(toks, ' ') as tokens from names", ("listing",), NAMES)
def tokenize(spark, folder):
    return listing(spark, folder).select("product_id", F.array_join(text.tokens(F.col("name_only")), " ").alias("tokens"))


@query("idf", "select token, df, round(idf, 6) as idf from vocabulary", ("listing",), VOCABULARY)
def idf(spark, folder):
    return vocabulary(spark, folder).select("token", "df", *rounded("idf"))


@query("top_tokens", "select product_id, token, cast(rank as integer) as rank from ranked where rank <= 4", ("listing",), RANKED)
def top_tokens(spark, folder):
    names = listing(spark, folder).select("product_id", "name_only")
    return corpus.top_tokens(names, vocabulary(spark, folder), K.SINGLE_TOKENS).select("product_id", "token", "rank")


@query("name_blocks", """
select l.product_id, coalesce(string_agg(block, ' ' order by place), '') as block_tokens
from listing l left join blocks b on l.product_id = b.product_id group by l.product_id""", ("listing",), BLOCKS)
def name_blocks(spark, folder):
    names = listing(spark, folder).select("product_id", "name_only")
    blocked = corpus.with_block_tokens(names, vocabulary(spark, folder))
    return blocked.select("product_id", F.array_join("block_tokens", " ").alias("block_tokens"))


def exploded(spark, folder):
    names = listing(spark, folder).select("product_id", "shop", "own_brand", "name_only")
    return corpus.explode_blocks(corpus.with_block_tokens(names, vocabulary(spark, folder)))


@query("explode_blocks", "select product_id, block_key from block_rows", ("listing",), KEYS)
def explode_blocks(spark, folder):
    return exploded(spark, folder).select("product_id", "block_key")


@query("dedup_product", "select product_id, shop, name_only from listing", ("listing",))
def dedup_product(spark, folder):
    return corpus.one_row_per_product(exploded(spark, folder)).select("product_id", "shop", "name_only")


# --- embeddings ---


@query("hash_embed", "select product_id, unnest(range(64)) as place, round(unnest(vector), 6) as value from vectors", ("listing",),
       vectors("listing"))
def hash_embed(spark, folder):
    vectors_ = encode(plan.listing_sides(spark, folder).select("product_id", "product_text"))
    placed = vectors_.select("product_id", F.posexplode("embedding").alias("place", "value"))
    return placed.select("product_id", F.col("place").cast("bigint").alias("place"), F.round(F.col("value").cast("double"), 6).alias("value"))


VECTOR_PAIRS = """select d.doc_id, a.embedding::double[] as x, b.embedding::double[] as y from documents d
join embeddings a on a.vec_id = d.doc_id % (select count(*) from embeddings)
join embeddings b on b.vec_id = d.n_chars % (select count(*) from embeddings)"""


def vector_pairs(spark, folder):
    """Two stored vectors per document, picked by its id and by its length."""
    stored = table(spark, folder, "embeddings").select("vec_id", "embedding")
    n = stored.agg(F.count(F.lit(1)).alias("n")).scalar()
    docs = table(spark, folder, "documents").select("doc_id", (F.col("doc_id") % n).alias("i"), (F.col("n_chars") % n).alias("j"))
    left, right = stored.toDF("i", "x"), stored.toDF("j", "y")
    return docs.join(left, "i").join(right, "j")


@query("pair_cosine", "select doc_id, round(list_inner_product(x, y), 6) as cosine from vector_pairs", ctes=(("vector_pairs", VECTOR_PAIRS),))
def pair_cosine(spark, folder):
    pairs = vector_pairs(spark, folder)
    return pairs.select("doc_id", F.round(similarity.dot_product(F.col("x"), F.col("y")), 6).alias("cosine"))


@query("cosine_norm", "select doc_id, round(list_cosine_similarity(x, y), 6) as cosine from vector_pairs", ctes=(("vector_pairs", VECTOR_PAIRS),))
def cosine_norm(spark, folder):
    pairs = vector_pairs(spark, folder)
    return pairs.select("doc_id", F.round(similarity.cosine(F.col("x"), F.col("y")), 6).alias("cosine"))


# --- candidates and scores ---


@query("candidate_rows", """
select block_key, count(*) filter (where shop = 0) as n_a, count(*) filter (where shop = 1) as n_b,
  cast(count(*) filter (where shop = 0) as double) * count(*) filter (where shop = 1) as n_pairs
from block_rows group by block_key having count(*) filter (where shop = 0) > 0 and count(*) filter (where shop = 1) > 0""",
       ("listing",), KEYS)
def candidate_rows(spark, folder):
    """All candidate rows, repeats for several shared keys included, as one row per block with its numbers."""
    side = F.when(F.col("shop") == 0, "a").otherwise("b")
    rows = exploded(spark, folder).select(side.alias("side"), "block_key", F.lit(1).alias("copies"))
    return matching.block_sizes(rows)


IDS = ("product_id_a", "product_id_b", "copies_a", "copies_b")  # a pair stands for copies_a x copies_b pairs of products
SQL_IDS = ", ".join(IDS)


def candidates(spark, folder, *columns):
    """Candidate pairs of profiles (products that agree in all the score reads count as one) with their copies."""
    return matching.candidate_pairs(catalogues(spark, folder).profiles, columns=("copies", *columns))


@query("candidate_pairs", f"""
select {SQL_IDS} from candidates join (select product_id as product_id_a, copies as copies_a from profiles) a using (product_id_a)
join (select product_id as product_id_b, copies as copies_b from profiles) b using (product_id_b)""", ("listing",), PAIRS)
def candidate_pairs(spark, folder):
    return candidates(spark, folder).select(*IDS)


def pair_column(name, sql, column, *brought):
    @query(name, f"select {SQL_IDS}, round({sql}, 6) as similarity from parts", ("listing",), PARTS)
    def similarity_of_pairs(spark, folder):
        return candidates(spark, folder, *brought).select(*IDS, F.round(column(), 6).alias("similarity"))

    return similarity_of_pairs


def both(column):
    return F.col(f"{column}_a"), F.col(f"{column}_b")


pair_column("jaccard", "jacc", lambda: similarity.jaccard(*both("name_tokens")), "name_tokens")
pair_column("quantity_sim", "quantity_score", lambda: similarity.quantity_similarity(*both("quantity")))
pair_column("price_sim", "price_score", lambda: similarity.price_similarity(*both("price")))

PART_COLUMNS = ("embedding_score", "name_fuzz_score", "name_jacc_score", "quantity_score", "price_score")
SQL_PARTS = ("round(cos, 6) as embedding_score, round(fuzz, 6) as name_fuzz_score, round(jacc, 6) as name_jacc_score, "
             "round(quantity_score, 6) as quantity_score, round(price_score, 6) as price_score, round(score, 6) as score")


def pairs_above(spark, folder):
    return plan.scored_pairs(catalogues(spark, folder))


def all_scored(spark, folder):
    return plan.scored_pairs(catalogues(spark, folder), threshold=None)


@query("fuzz_score", f"select {SQL_IDS}, round(fuzz, 6) as name_fuzz_score from parts join common using (sa, sb)",
       ("listing",), PARTS + common("parts"))
def fuzz_score(spark, folder):
    """Every candidate pair, compared character by character."""
    return all_scored(spark, folder).select(*IDS, *rounded("name_fuzz_score"))


@query("match_score", f"select {SQL_IDS}, {SQL_PARTS} from (select *, {SCORE} as score from parts join common using (sa, sb)) p",
       ("listing",), PARTS + common("parts"))
def match_score(spark, folder):
    """All five similarities and the score of every candidate pair."""
    return all_scored(spark, folder).select(*IDS, *rounded(*PART_COLUMNS, "score"))


@query("high_score_pairs", """
select product_id_a, product_id_b, copies_a, copies_b, name_only_a, name_only_b, price_a, price_b, quantity_a, quantity_b,
  round(score, 6) as score from pairs""", ("listing",), SCORED)
def high_score_pairs(spark, folder):
    """Pairs above the threshold; a pair stands for copies_a x copies_b equal pairs of products."""
    return pairs_above(spark, folder).select(
        "product_id_a", "product_id_b", "copies_a", "copies_b", "name_only_a", "name_only_b", "price_a", "price_b",
        "quantity_a", "quantity_b", *rounded("score")
    )


@query("best_match", """
select href, product_id as product_id_a, product_id_b, name_only_a, name_only_b, price_a, price_b, round(score, 6) as score
from best""", ("listing",), BEST)
def best_match(spark, folder):
    return plan.match(plan.listing_sides(spark, folder)).select(
        "href", "product_id_a", "product_id_b", "name_only_a", "name_only_b", "price_a", "price_b", *rounded("score")
    )


@query("blocking_stats", """
select (select cast(count(*) as double) from listing where shop = 0) * (select count(*) from listing where shop = 1) as all_pairs,
  (select cast(sum(cast(a as double) * b) as double) from (select count(*) filter (where shop = 0) as a, count(*) filter (where shop = 1) as b
    from block_rows group by block_key) s) as candidate_rows,
  (select sum(cast(copies_a as double) * copies_b) from pairs) as high_score_pairs,
  (select count(*) from best) as matches""", ("listing",), BEST)
def blocking_stats(spark, folder):
    """Pairs without blocking, candidate rows, pairs above the threshold and matched products."""
    ready = catalogues(spark, folder)
    # the pairs are made once and never written: their number and the best one, per profile
    order = F.struct("score", F.bitwise_not("product_id_b"))
    pairs = stage(plan.scored_pairs(ready).groupBy("product_id_a").agg(
        F.sum(F.col("copies_a").cast("double") * F.col("copies_b")).alias("high"),
        F.max_by(F.struct("product_id_b", "score", "profile_key_a"), order).alias("best"),
    ), "pairs-per-profile")
    found = matching.best_matches(pairs.select("product_id_a", "best.*"), ready.members)
    sides = ready.members.agg(
        (F.count_if(F.col("side") == "a").cast("double") * F.count_if(F.col("side") == "b")).alias("all_pairs")
    )
    rows = candidate_rows(spark, folder).agg(F.sum("n_pairs").alias("candidate_rows"))
    high = pairs.agg(F.sum("high").alias("high_score_pairs"))
    return sides.select(
        "all_pairs", rows.scalar().alias("candidate_rows"), high.scalar().alias("high_score_pairs"),
        found.agg(F.count(F.lit(1)).alias("matches")).scalar().alias("matches"),
    )
