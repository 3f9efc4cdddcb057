"""Blocked matching of two catalogues.

Copies are collapsed to profiles and each profile is encoded once. Rows, never pairs, are shuffled: profiles go into cells
sized by the work with all that their pairs are scored on, and a pair is made, dropped by the exact score ceiling or
scored in the task of its cell. Only the best pair of a profile reaches another shuffle.
"""

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch import constants as K
from shelfmatch.functions import cells, similarity, text
from shelfmatch.operators import cleaning, corpus, zones
from shelfmatch.operators.embedding import HashedTokens, encode
from shelfmatch.sources import vector_store
from shelfmatch.sources.staging import broadcast_if_small, drop, mark, since, stage

MIN_CELL_ROWS = 50  # rows of one side in the smallest join cells
TASK_PAIRS = 400_000  # pairs one join task should look at, and score
TASK_BOUNDS = 20_000_000  # pairs one join task should look at where their bounds are computed together
LIST_ROWS = 4_000  # of a cell that are handed to Python in one list
TASK_ROWS = 100_000  # rows one join task should hold, with names and vectors
MOST_TASKS = 20_000  # of the pair join; beyond that a task looks at more pairs, never at more rows together
CELLS_PER_TASK = 4
CELLS_PER_CORE = 8  # of the largest cells; few, as a row is repeated for each cell along its line
CELL_PAIRS = 1_000_000  # of a cell that is larger than it must be: those that pass wait for Python and are sorted in its task
MOST_CELL_ROWS = 25_000  # rows of one side that a cell may hold so that rows are repeated less
ZONED_PAIRS = 100_000_000  # pairs of a block from which it is joined zone by zone
SLACK = 1e-6  # stored float vectors have length one only up to rounding

PROFILE_FIELDS = ("name_only", "own_brand", "quantity", "price", "product_text")


class Catalogues(NamedTuple):
    """Two catalogues made ready for matching; all three tables are staged."""

    members: DataFrame  # every product, narrow, with the key of its profile
    profiles: DataFrame  # one row per side and profile, with vector, tokens and block keys
    vocabulary: DataFrame
    best_only: bool = False  # whether of the pairs of a product of side a only the best is asked for


def profile_key():
    """Products that agree in everything the score reads get the same key: 128 bits of a hash as bytes, as key rows carry it
    through the shuffle."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in PROFILE_FIELDS]
    return F.unhex(F.substring(F.sha2(F.concat_ws("\u0001", *shown), 256), 1, 32))


def prepare(products: DataFrame, make_encoder=HashedTokens, null_blocks="match", store: str | None = None, encoder_id: str | None = None) -> Catalogues:
    """Collapse copies to profiles, encode each profile once and give it its block keys.

    ``products``: side ('a' or 'b'), product_id, href, name_only, own_brand, quantity, price, product_text.
    ``null_blocks='match'`` lets all products without block tokens meet, ``'drop'`` leaves them out. With ``store``, the
    path of a vector store, only texts without a vector of the encoder named ``encoder_id`` are encoded.

    ``products`` is read twice and must give the same rows: the texts to encode, which are most of it, are read again for
    the encoder instead of being written, and cross a shuffle only if the scan has too few tasks for a costly encoder or
    the first rows of all profiles are too many to broadcast.
    """
    if store is not None and not encoder_id:
        raise ValueError("a vector store needs the name of the encoder")
    cleaning.require(products, "side", "product_id", "href", *PROFILE_FIELDS)
    keys = ["side", "product_id"]
    spark = products.sparkSession
    begun = mark(spark)
    keyed = products.withColumn("profile_key", profile_key())
    listed = stage(keyed.select(*keys, "href", "name_only", "profile_key"), "listed")
    wide = since(spark, begun)  # holds the names and is deleted as soon as the profiles are written
    members = stage(listed.select(*keys, "href", "profile_key"), "members")
    vocab = stage(corpus.vocabulary(listed), "vocabulary")
    # grouped are keys and ids only, as partial minima and counts, so a profile with very many copies is no hot group
    firsts = stage(members.groupBy("side", "profile_key").agg(
        F.min("product_id").alias("product_id"), F.count(F.lit(1)).alias("copies")
    ).drop("profile_key"), "firsts")
    names = listed.select(*keys, "name_only").join(firsts.select(*keys), keys)
    ranked = corpus.ranked_token_lists(names, broadcast_if_small(vocab), keys)
    blocks = corpus.matching_blocks(ranked, vocab, keys)
    block_keys = F.transform(F.array_distinct("blocks"), lambda t: corpus.block_key(F.col("own_brand"), t))
    no_keys = F.array(F.lit(corpus.NULL_BLOCK)) if null_blocks == "match" else F.array().cast("array<string>")
    # the encoder is the costly part: texts are encoded where they are read if enough tasks had rows to write, else dealt
    # over all tasks by the keys of the join
    few = broadcast_if_small(firsts)
    kept = keyed.drop("href")
    if few is firsts or len(listed.inputFiles()) < spark.sparkContext.defaultParallelism:
        kept = kept.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    kept = kept.join(few, keys)
    if store is None:
        encoded = encode(kept, "product_text", make_encoder)
    else:
        begun = mark(spark)
        encoded = vector_store.with_vectors(stage(kept, "kept"), store, encoder_id, make_encoder)
        wide = wide + since(spark, begun)  # the texts that the store was asked for
    profiles = encoded.join(blocks, keys, "left").select(
        *keys, "profile_key", "copies", "name_only", "own_brand", "quantity", "price", "embedding",
        F.array_distinct(text.tokens(F.col("name_only"))).alias("name_tokens"),
        text.sorted_words(F.col("name_only")).alias("sorted_name"),
        F.when(F.size("blocks") > 0, block_keys).otherwise(no_keys).alias("keys"),
    )
    ready = Catalogues(members, stage(profiles, "profiles"), vocab)
    drop(spark, wide)
    return ready


def block_sizes(exploded: DataFrame) -> DataFrame:
    """(block_key, n_a, n_b, n_pairs) for blocks with rows on both sides: all candidate rows, counted, not listed. The
    product is a double, as that of two long counts need not be a long."""

    def rows(side):
        return F.sum(F.when(F.col("side") == side, F.col("copies")).otherwise(0))

    sizes = exploded.groupBy("block_key").agg(rows("a").alias("n_a"), rows("b").alias("n_b"))
    return sizes.where((F.col("n_a") > 0) & (F.col("n_b") > 0)).withColumn("n_pairs", F.col("n_a").cast("double") * F.col("n_b"))


def _cells(rows: DataFrame, grid: DataFrame, side: str, on: list[str]) -> DataFrame:
    """Put key rows into join cells. What ``grid`` splits becomes a grid: a row picks its line (or column) by its id and
    is repeated along it, so that every pair meets in exactly one cell."""
    own, other = ("cell_a", "cell_b") if side == "a" else ("cell_b", "cell_a")
    parts = {"cell_a": F.coalesce("parts_a", F.lit(1)), "cell_b": F.coalesce("parts_b", F.lit(1))}
    spread = rows.join(grid, on, "left" if on == ["block_key"] else "inner")
    spread = spread.withColumn(own, F.pmod(F.xxhash64(F.lit("cell"), "product_id"), parts[own]).cast("int"))
    return spread.withColumn(other, F.explode(F.sequence(F.lit(0), (parts[other] - 1).cast("int")))).drop("parts_a", "parts_b")


class Layout(NamedTuple):
    """How the key rows of both sides are put into join cells; the tables are staged."""

    sizes: DataFrame  # of the blocks that are joined whole
    zoned: DataFrame | None  # (block_key, larger): the blocks that are joined zone by zone, if any
    zone_pairs: DataFrame | None  # the pairs of zones that are joined
    pairs: int  # that meet in all cells
    tasks: int
    cell_rows: int


def layout(rows: DataFrame, threshold: float | None, task_pairs: int = TASK_PAIRS, cell_pairs: int = CELL_PAIRS) -> Layout:
    """Measure the work of the pair join and lay it out. ``rows``: side, block_key and the numbers of the score."""
    spark = rows.sparkSession
    # one narrow row per block; staged, as the work is measured before the join is laid out
    sizes = stage(block_sizes(rows.select("side", "block_key", F.lit(1).alias("copies"))), "block-sizes")
    largest = sizes.agg(F.max("n_pairs")).first()[0] or 0
    zoned, pairs_of_zones, whole = None, None, sizes
    work = sizes.select("n_a", "n_b")
    if threshold is not None and largest >= ZONED_PAIRS:
        large = F.col("n_pairs") >= ZONED_PAIRS
        zoned = stage(sizes.where(large).select("block_key", F.greatest("n_a", "n_b").alias("larger")), "zoned-blocks")
        inside = rows.join(broadcast_if_small(zoned), "block_key").withColumn("zone", zones.zone(F.col("larger")))
        pairs_of_zones = stage(zones.zone_pairs(zones.zone_maps(inside), threshold - SLACK), "zone-pairs")
        whole = sizes.where(~large)
        work = whole.select("n_a", "n_b").unionByName(pairs_of_zones.select("n_a", "n_b"))
    sums = work.agg(
        F.sum(F.col("n_a").cast("double") * F.col("n_b")).alias("pairs"), F.sum(F.col("n_a") + F.col("n_b")).alias("rows"),
        F.max(F.greatest("n_a", "n_b")).alias("side"),
    ).first()
    pairs, size = int(sums["pairs"] or 0), sums["rows"] or 0
    # a fixed number by work: sized by bytes, the narrow rows would land in a few tasks that then make all the pairs
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(shuffle, min(MOST_TASKS, max(pairs // task_pairs, size // TASK_ROWS)))
    by_pairs = math.isqrt(pairs // (CELLS_PER_TASK * tasks))
    # a row is repeated once per line of the grid: a bound by the cluster, as one by pairs would grow with the block, and
    # the shuffled bytes with its square. The largest block still fills all tasks, and so do the pairs of all blocks
    # together: cells smaller than that only repeat rows, in every block that is cut
    by_rows = math.ceil((sums["side"] or 0) / math.isqrt(CELLS_PER_TASK * shuffle))
    by_cores = math.isqrt(min(cell_pairs, pairs // max(shuffle, CELLS_PER_CORE * spark.sparkContext.defaultParallelism)))
    cell_rows = max(MIN_CELL_ROWS, by_pairs, min(MOST_CELL_ROWS, max(by_rows, by_cores)))
    return Layout(whole, zoned, pairs_of_zones, pairs, tasks, cell_rows)


def _parts(embedding, fuzz, jacc):
    return embedding, fuzz, jacc, F.col("quantity_score"), F.col("price_score")


def _can_pass(embedding, fuzz, jacc, threshold):
    """Rounding, which is costly per pair, is far below the slack."""
    return similarity.weighted_sum(*_parts(embedding, fuzz, jacc)) > threshold - SLACK


def _fuzz_ceiling():
    return similarity.fuzz_ceiling(F.col("name_length_a"), F.col("name_length_b"))


def _with_number_scores(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({
        "quantity_score": similarity.quantity_similarity(F.col("quantity_a"), F.col("quantity_b")),
        "price_score": similarity.price_similarity(F.col("price_a"), F.col("price_b")),
    })


def candidate_pairs(profiles: DataFrame, threshold: float | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """(product_id, quantity, price, name_length, n_tokens and ``columns`` of both sides, suffix _a and _b;
    quantity_score, price_score) of every pair of profiles that shares a block key, once; with a threshold, of those
    that can still pass it.

    The rows that are exploded, repeated along the grid and shuffled bring the ``columns`` with them, as rows in cells are
    few beside the pairs they make: fetched for the pairs, they would be shuffled with each pair. Keys are 128-bit
    hashes. A pair that meets in several blocks is kept in the first of its shared keys only, which needs no
    ``distinct``. The ceiling takes the cosine as one, the names as alike as their lengths allow and the token sets as
    nested, so it is exact. With a threshold, large blocks are joined zone by zone (``zones``), without the zones whose
    pairs are all below it.
    """
    if threshold is not None:  # without these two there is no score
        profiles = profiles.where("quantity is not null and price is not null")
    plan, placed = _placed(profiles, threshold, columns)
    cell = _cell(plan)
    met = placed("a").hint("merge").join(placed("b"), cell)
    met = _with_number_scores(met)
    if threshold is not None:
        met = met.where(_can_pass(F.lit(1.0), _fuzz_ceiling(), _nested(), threshold))
    alone = (F.size("lower_keys_a") == 0) | (F.size("lower_keys_b") == 0)
    first_shared = F.when(alone, F.lit(True)).otherwise(~F.arrays_overlap("lower_keys_a", "lower_keys_b"))
    return met.where(first_shared).drop("lower_keys_a", "lower_keys_b", *cell)


def _nested():
    most = F.greatest("n_tokens_a", "n_tokens_b")
    return F.when(most > 0, F.least("n_tokens_a", "n_tokens_b") / most).otherwise(F.lit(0.0))


def _cell(plan: Layout) -> list[str]:
    return ["block_key", "cell_a", "cell_b"] + ([] if plan.zoned is None else ["zone_a", "zone_b"])


def _placed(profiles: DataFrame, threshold: float | None, columns: tuple[str, ...], **options):
    """The layout of the pair join (``options`` are its own), and a function that gives the rows of a side in its cells, with ``columns``."""
    hashed = F.transform("keys", lambda k: F.struct(F.xxhash64(k).alias("h"), F.xxhash64(F.lit(1), k).alias("g")))
    narrow = profiles.select(
        "side", "product_id", "quantity", "price", F.length("sorted_name").alias("name_length"),
        F.size("name_tokens").alias("n_tokens"), hashed.alias("keys"),
    )
    rows = narrow.withColumn("block_key", F.explode("keys"))
    plan = layout(rows, threshold, **options)
    if columns:  # by id, so that each row of an id meets the columns of all of them
        narrow = narrow.join(profiles.select("side", "product_id", *columns), ["side", "product_id"])
    exploded = narrow.withColumn("block_key", F.explode("keys"))
    rows = exploded.withColumn("lower_keys", F.filter("keys", lambda k: k < F.col("block_key"))).drop("keys")

    def parts(n):  # small parts of a fair share
        return F.ceil(F.col(n) / plan.cell_rows).cast("int")

    is_hot = (F.col("n_a") > plan.cell_rows) | (F.col("n_b") > plan.cell_rows)
    grid = [parts("n_a").alias("parts_a"), parts("n_b").alias("parts_b")]
    hot = broadcast_if_small(stage(plan.sizes.where(is_hot).select("block_key", *grid), "hot-blocks"))  # else a shuffle join, whose skewed side AQE splits
    cell = _cell(plan)
    if plan.zoned is not None:
        zoned, pairs_of_zones = broadcast_if_small(plan.zoned), broadcast_if_small(plan.zone_pairs)

    def placed(side):
        own = mine = rows.where(F.col("side") == side).drop("side")
        if plan.zoned is None:
            own = _cells(mine, hot, side, ["block_key"])
        else:
            whole = _cells(mine.join(zoned, "block_key", "left_anti"), hot, side, ["block_key"]).withColumns({"zone_a": F.lit(""), "zone_b": F.lit("")})
            inside = mine.join(zoned, "block_key").withColumn(f"zone_{side}", zones.zone(F.col("larger"))).drop("larger")
            own = whole.unionByName(_cells(inside, pairs_of_zones.select("block_key", "zone_a", "zone_b", *grid), side, ["block_key", f"zone_{side}"]))
        names = {c: f"{c}_{side}" for c in own.columns if c not in cell}
        return own.withColumnsRenamed(names).repartition(plan.tasks, *cell)

    return plan, placed


def with_names(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pairs, no more than a few per profile, with the names of both sides: by broadcast, if those of all profiles are small;
    else by a join that splits a profile in very many pairs, as the other side has one row per profile."""
    keys = ("product_id", "profile_key")
    names = broadcast_if_small(stage(profiles.select("side", *keys, "name_only").distinct(), "names"))
    for side in ("a", "b"):
        own = names.where(F.col("side") == side).drop("side")
        pairs = pairs.join(own.withColumnsRenamed({c: f"{c}_{side}" for c in own.columns}), [f"{c}_{side}" for c in keys])
    return pairs


SCORE_COLUMNS = ("name_tokens", "sorted_name", "embedding")
PAIR_COLUMNS = ("profile_key", "copies", "name_only", "own_brand")


def score_pairs(profiles: DataFrame, threshold: float | None = K.PAIR_THRESHOLD, best_only: bool = False) -> DataFrame:
    """The candidate pairs with their five similarities and weighted score; with a threshold only the pairs above it, and
    with ``best_only`` of those only the ones that may be the best of their product of side a, without names.

    The rows bring 64-bit hashes of their tokens and packed vectors: both are smaller in the shuffle and quicker to compare.
    With a threshold the rows of a cell go to Python as lists, where exact bounds of the score of all their pairs are
    computed together (``cells``) and only pairs that can pass are compared character by character; pairs that cannot are
    never made.
    """
    numbers = "float32" if isinstance(profiles.schema["embedding"].dataType.elementType, T.FloatType) else "float64"
    compact = profiles.withColumns({
        "name_tokens": F.transform("name_tokens", lambda t: F.xxhash64(t)), "embedding": similarity.packed(F.col("embedding")),
    })
    if threshold is not None:
        return _pairs_above(compact, threshold, best_only, numbers)
    parts = candidate_pairs(compact, None, PAIR_COLUMNS + SCORE_COLUMNS)
    parts = parts.withColumn("name_jacc_score", similarity.jaccard(F.col("name_tokens_a"), F.col("name_tokens_b")))
    parts = parts.withColumn("embedding_score", similarity.packed_product(F.col("embedding_a"), F.col("embedding_b"), numbers))
    parts = parts.drop("embedding_a", "embedding_b", "name_tokens_a", "name_tokens_b")
    scored = parts.withColumn("name_fuzz_score", similarity.fuzz_ratio(F.col("sorted_name_a"), F.col("sorted_name_b")))
    return _with_score(scored)


def _with_score(pairs: DataFrame) -> DataFrame:
    parts = _parts(F.col("embedding_score"), F.col("name_fuzz_score"), F.col("name_jacc_score"))
    gone = [f"{c}_{side}" for c in ("sorted_name", "name_length", "n_tokens") for side in "ab"]
    return pairs.withColumn("score", similarity.weighted_score(*parts)).drop(*gone)


def _pairs_above(profiles: DataFrame, threshold: float, best_only: bool, numbers: str) -> DataFrame:
    # without these two there is no score
    profiles = profiles.where("quantity is not null and price is not null")
    columns = tuple(c for c in PAIR_COLUMNS if not (best_only and c == "name_only"))
    # pairs are never held all together, so a cell may have as many as its rows make, if all tasks have work
    plan, placed = _placed(profiles, None, columns + SCORE_COLUMNS, task_pairs=TASK_BOUNDS, cell_pairs=MOST_CELL_ROWS**2)
    cell = _cell(plan)

    def lists(side):
        """The rows of a cell as lists that are no more than some megabytes, however large the cell."""
        own = placed(side)
        if best_only:  # the best pair is the best one however often it is found
            own = own.drop(f"lower_keys_{side}")
        number = F.pmod(F.xxhash64(F.lit("list"), f"product_id_{side}"), F.lit(math.ceil(plan.cell_rows / LIST_ROWS)))
        row = F.struct(*[F.col(c).alias(c.removesuffix(f"_{side}")) for c in own.columns if c not in cell])
        return own.groupBy(*cell, number.alias(f"list_{side}")).agg(F.collect_list(row).alias(f"rows_{side}"))

    met = lists("a").hint("merge").join(lists("b"), cell).select("rows_a", "rows_b")
    given = met.schema["rows_a"].dataType.elementType
    fields = ("product_id", "quantity", "price", "name_length", "n_tokens", *columns)
    found = T.StructType([T.StructField(f"{c}_{side}", given[c].dataType) for side in "ab" for c in fields])
    for name in cells.SCORES:
        found = found.add(name, "double")
    pairs = _with_number_scores(met.mapInArrow(cells.scorer(threshold, best_only, numbers, fields), found))
    cosine, jacc = F.col("embedding_score"), F.col("name_jacc_score")
    for part in ((F.lit(1.0), _nested()), (F.lit(1.0), jacc), (cosine, jacc)):  # the ceilings by the numbers of the rows
        pairs = pairs.where(_can_pass(part[0], _fuzz_ceiling(), part[1], threshold))
    return _with_score(pairs).where(F.col("score") > threshold)


def best_per_profile(pairs: DataFrame) -> DataFrame:
    """The best partner of each profile of side a, ties by the lower product id of side b."""
    order = Window.partitionBy("product_id_a").orderBy(F.desc("score"), "product_id_b")
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1).drop("place")


def best_matches(pairs: DataFrame, members: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """One row per href of side a: its best pair. Copies of a product share the pair of their profile. With ``profiles``
    the pairs are sorted without their names, which are fetched for the best ones."""
    if profiles is None:
        best = best_per_profile(pairs)
    else:
        best = with_names(best_per_profile(pairs.drop("name_only_a", "name_only_b")), profiles)
    best = best.withColumnRenamed("profile_key_a", "profile_key").drop("product_id_a")
    own = members.where(F.col("side") == "a").select("product_id", "href", "profile_key")
    # many products to one profile: a hot profile splits by the skew join, as the other side has one row per key
    spread = own.join(best, "profile_key").withColumnRenamed("product_id", "product_id_a")
    order = Window.partitionBy("href").orderBy(F.desc("score"), "product_id_b", "product_id_a")
    return spread.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1).drop("place", "profile_key")


def expand_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """List pairs product by product, for callers that want the copies of a profile spelled out."""

    def of(side):
        return members.where(F.col("side") == side).select(
            F.col("profile_key").alias(f"profile_key_{side}"), F.col("product_id").alias(f"product_id_{side}")
        )

    profiles = pairs.drop("product_id_a", "product_id_b")
    return profiles.join(of("a"), "profile_key_a").join(of("b"), "profile_key_b")
