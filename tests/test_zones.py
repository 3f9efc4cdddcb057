"""Zone maps: equal results with and without them, and how many pairs of a large block are never made."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.operators import matching, zones


def profiles(spark, n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = sorted(draw.choices(["melk", "kaas", "brood", "jam", "halfvolle", "oude", "x", "appelstroop"], k=draw.randrange(1, 9)))
        quantity = draw.choice([None, 0.0, -1.0, *[10 ** draw.uniform(-3, 3) for _ in range(20)]])
        keys = ["hot"] + draw.choices(["k1", "k2", "k3"], k=draw.randrange(3))
        rows.append(("ab"[i % 2], i, quantity, draw.choice([None, 0.0, *[10 ** draw.uniform(-1, 2) for _ in range(20)]]), " ".join(words), sorted(set(words)), sorted(set(keys))))
    kind = "side string, product_id long, quantity double, price double, sorted_name string, name_tokens array<string>, keys array<string>"
    return spark.createDataFrame(rows, kind)


def test_zoned_blocks_give_the_same_pairs(spark, monkeypatch):
    table = profiles(spark, 400)

    def found():
        return sorted((r.product_id_a, r.product_id_b) for r in matching.candidate_pairs(table, K.PAIR_THRESHOLD).collect())

    whole = found()
    assert len(set(whole)) == len(whole) > 100
    for pairs, cell_rows, fine in ((100, 5, 100_000), (100, 50, 10), (1, 1000, 100_000)):
        monkeypatch.setattr(matching, "ZONED_PAIRS", pairs)
        monkeypatch.setattr(matching, "MIN_CELL_ROWS", cell_rows)
        monkeypatch.setattr(zones, "FINE_ROWS", fine)
        assert found() == whole


def test_no_pair_scores_above_the_best_of_its_zones(spark):
    """Every pair of rows against the bound of its two zones."""
    rows = profiles(spark, 120).where("quantity is not null and price is not null").select(
        "side", "product_id", "quantity", "price", F.length("sorted_name").alias("name_length"), F.size("name_tokens").alias("n_tokens"), F.lit("hot").alias("block_key"))
    zoned = rows.withColumn("zone", zones.zone(F.lit(10)))
    bounds = {(r.zone_a, r.zone_b) for r in zones.zone_pairs(zones.zone_maps(zoned), K.PAIR_THRESHOLD).collect()}
    held = zoned.collect()
    lost = 0
    for a, b in itertools.product([r for r in held if r.side == "a"], [r for r in held if r.side == "b"]):
        if min(a.quantity, b.quantity) <= 0 or min(a.price, b.price) <= 0:
            assert (a.zone, b.zone) in bounds
            continue
        fuzz = 2 * min(a.name_length, b.name_length) / (a.name_length + b.name_length)
        near = [min(x, y) / max(x, y) for x, y in ((a.n_tokens, b.n_tokens), (a.quantity, b.quantity), (a.price, b.price))]
        best = K.WEIGHTS["embedding"] + K.WEIGHTS["fuzz"] * fuzz + K.WEIGHTS["jaccard"] * near[0] + K.WEIGHTS["quantity"] * near[1] ** 2 + K.WEIGHTS["price"] * near[2]
        assert best <= K.PAIR_THRESHOLD or (a.zone, b.zone) in bounds
        lost += (a.zone, b.zone) not in bounds
    assert lost > 0


@pytest.mark.parametrize("n, most", [(12_000, 2.5), (400_000, 2.3)])
def test_a_large_block_meets_few_pairs_more_than_its_ceiling_lets_pass(spark, n, most):
    """A block of n x n rows with sizes from grams to tonnes and names of 4 to 400 characters, counted and not joined:
    no exact bound can drop the pairs whose numbers allow the threshold (a fifth of all here); zones drop most others."""
    rows = spark.range(2 * n).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("side"), F.col("id").alias("product_id"),
        F.pow(F.lit(10.0), F.rand(1) * 6 - 3).alias("quantity"), F.pow(F.lit(10.0), F.rand(2) * 4 - 1).alias("price"),
        F.pow(F.lit(10.0), F.rand(3) * 2 + 0.6).cast("int").alias("name_length"), F.pow(F.lit(10.0), F.rand(4) * 1.5).cast("int").alias("n_tokens"),
        F.lit("hot").alias("block_key"))
    plan = matching.layout(rows, K.PAIR_THRESHOLD)
    some = {side: np.array([r[:4] for r in rows.where(F.col("side") == side).limit(2000).select("quantity", "price", "name_length", "n_tokens").collect()]) for side in "ab"}
    quantity, price, length, tokens = (np.minimum(a[:, None], b) / np.maximum(a[:, None], b) for a, b in zip(some["a"].T, some["b"].T))
    w = K.WEIGHTS
    ceiling = w["embedding"] + w["fuzz"] * 2 * length / (1 + length) + w["jaccard"] * tokens + w["quantity"] * quantity**2 + w["price"] * price
    assert plan.zoned.count() == 1 and plan.pairs < most * (ceiling > K.PAIR_THRESHOLD).mean() * n * n
    assert plan.tasks <= max(8, matching.MOST_TASKS)
    repeated = plan.zone_pairs.groupBy("zone_a").agg(F.first("n_a").alias("n"), F.count(F.lit(1)).alias("times")).agg(F.sum(F.col("n") * F.col("times"))).first()[0]
    print(n, plan.pairs / n / n, (ceiling > K.PAIR_THRESHOLD).mean(), repeated / n)
    assert repeated < plan.pairs / 8  # rows are repeated less often than pairs are made


def test_one_kind_of_goods_among_others(spark):
    """Small goods on one side, large ones on the other: under a tenth of the pairs of a block of 4e5 x 4e5 are made."""
    n = 400_000
    size = F.when((F.col("id") % 2 == 0) == (F.col("id") % 100 < 95), 1.0).otherwise(1000.0)
    rows = spark.range(2 * n).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("side"), F.col("id").alias("product_id"), (size * (1 + F.rand(1))).alias("quantity"),
        (size * (1 + F.rand(2))).alias("price"), (F.when(size == 1, 10).otherwise(60) + F.col("id") % 7).cast("int").alias("name_length"),
        F.when(size == 1, 2).otherwise(9).alias("n_tokens"), F.lit("hot").alias("block_key"))
    plan = matching.layout(rows, K.PAIR_THRESHOLD)
    assert 0 < plan.pairs < n * n / 10
