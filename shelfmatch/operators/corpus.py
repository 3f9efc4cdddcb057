"""Corpus statistics and block keys."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import text
from shelfmatch.sources.staging import broadcast_if_small, stage

NULL_BLOCK = ""  # block of the products without any block token; no real key is empty


def union_catalogues(*catalogues: DataFrame) -> DataFrame:
    """All rows of all catalogues, repeats kept."""
    union = catalogues[0]
    for catalogue in catalogues[1:]:
        union = union.unionByName(catalogue)
    return union


def vocabulary(names: DataFrame, name="name_only", min_count=K.MIN_DOC_COUNT, max_share=K.MAX_DOC_SHARE) -> DataFrame:
    """Tokens within the document-frequency bounds: (token, df, idf).

    Equal names are counted first, so a name that fills much of the corpus is tokenised once; the token counts are
    then partial sums before the shuffle.
    """
    distinct = names.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("copies"))
    n = names.agg(F.count(F.lit(1)).cast("double").alias("n"))
    return (
        distinct.select("copies", F.explode(F.array_distinct(text.tokens(F.col("name")))).alias("token"))
        .groupBy("token")
        .agg(F.sum("copies").alias("df"))
        .where((F.col("df") >= min_count) & (F.col("df") <= max_share * n.scalar()))
        .select("token", "df", (F.log((1 + n.scalar()) / (1 + F.col("df"))) + 1).alias("idf"))
    )


def _known_tokens(products: DataFrame, vocab: DataFrame, keys: tuple, name: str) -> DataFrame:
    found = products.select(*keys, F.posexplode(text.tokens(F.col(name))).alias("pos", "token"))
    return found.where(F.length("token") >= K.MIN_TOKEN_LENGTH).join(vocab, "token")


def top_tokens(products: DataFrame, vocab: DataFrame, k: int, keys=("product_id",), name="name_only") -> DataFrame:
    """The ``k`` rarest vocabulary tokens of each name, ties in name order."""
    order = Window.partitionBy(*keys).orderBy(F.desc("idf"), "pos")
    ranked = _known_tokens(products, vocab, keys, name).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def ranked_token_lists(products: DataFrame, vocab: DataFrame, keys=("product_id",), name="name_only") -> DataFrame:
    """(keys, ranked): the rarest tokens per product, at most ``PAIR_TOKENS``; products without any are left out."""
    entries = F.collect_list(F.struct((-F.col("df")).alias("order"), (-F.col("pos")).alias("pos"), "token"))
    # descending on (-df, -pos) is rarest first, then first in the name; a list is one name, never a corpus
    best = F.slice(F.sort_array(entries, asc=False), 1, K.PAIR_TOKENS)
    grouped = _known_tokens(products, vocab, keys, name).groupBy(*keys).agg(best.alias("best"))
    return grouped.select(*keys, F.transform("best", lambda e: e["token"]).alias("ranked"))


def single_blocks(ranked):
    return F.slice(ranked, 1, K.SINGLE_TOKENS)


def pair_blocks(ranked):
    """Every two ranked tokens as ``a_b``, in rank order."""
    return F.flatten(
        F.transform(
            ranked,
            lambda a, i: F.transform(F.slice(ranked, i + 2, K.PAIR_TOKENS), lambda b: F.concat(a, F.lit("_"), b)),
        )
    )


def name_blocks(ranked):
    """Block tokens of a product: singles, then pairs."""
    ranked = F.coalesce(ranked, F.array().cast("array<string>"))
    return F.concat(single_blocks(ranked), pair_blocks(ranked))


def block_key(own_brand, token):
    return F.concat(F.initcap(own_brand.cast("string")), F.lit("_"), token)


def with_block_tokens(products: DataFrame, vocab: DataFrame, keys=("product_id",), name="name_only") -> DataFrame:
    ranked = ranked_token_lists(products, vocab, keys, name)
    return products.join(ranked, list(keys), "left").withColumn("block_tokens", name_blocks(F.col("ranked")))


def matching_blocks(ranked: DataFrame, vocab: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, blocks): the block tokens of each product that are enough to find every pair.

    Two ranked tokens that form a shared pair key share their first token as a single key too, since that token is
    among the first four on both sides. Other pair keys matter only where a token itself holds the separator: those
    equal to such a token, and those with several separators. Only the products that have one of these get it.
    """
    singles = single_blocks(F.col("ranked"))
    separated = stage(vocab.where(F.col("token").contains("_")).select("token"), "separated")
    if separated.isEmpty():
        return ranked.select(*keys, singles.alias("blocks"))
    listed = ranked.select(*keys, F.explode(pair_blocks(F.col("ranked"))).alias("token"))
    several = F.col("token").rlike("_.*_")
    equal = listed.where(~several).join(broadcast_if_small(separated), "token", "left_semi").select(*keys, "token")
    extra = listed.where(several).union(equal).groupBy(*keys).agg(F.collect_set("token").alias("extra"))
    blocks = F.concat(singles, F.coalesce("extra", F.array().cast("array<string>")))
    return ranked.join(extra, keys, "left").select(*keys, blocks.alias("blocks"))


def explode_blocks(blocked: DataFrame) -> DataFrame:
    """One row per product and block key; a product without tokens keeps one row with a null key."""
    exploded = blocked.select("*", F.explode_outer("block_tokens").alias("block_token"))
    return exploded.withColumn("block_key", block_key(F.col("own_brand"), F.col("block_token"))).drop("block_token")


def one_row_per_product(exploded: DataFrame, key="product_id") -> DataFrame:
    """Undo ``explode_blocks``: the other columns are equal within a product."""
    return exploded.drop("block_key").dropDuplicates([key])
