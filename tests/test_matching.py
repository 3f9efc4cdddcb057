"""Blocked matching against a plain Python account of the rules, on small and on skewed catalogues."""

import itertools
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import similarity
from shelfmatch.operators import matching, prices
from shelfmatch.operators.embedding import HashedTokens
from shelfmatch.plans import matching as plan
from shelfmatch.sources import staging

SCHEMA = "side string, product_id long, href string, name_only string, own_brand boolean, quantity double, price double, product_text string"


def toks(name):
    return [t for t in re.findall(r"\w+", name.lower()) if t not in K.STOPWORDS]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
    return row[-1]


def expected(rows, null_blocks="match"):
    """All scored candidate pairs of products."""
    n = len(rows)
    df = Counter(t for r in rows for t in set(toks(r[3])))
    vocab = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items() if 3 <= d <= 0.2 * n}
    vectors = HashedTokens()([r[7] for r in rows]).astype(float)

    def keys(r):
        ranked = sorted((t for t in toks(r[3]) if t in vocab and len(t) > 2), key=lambda t: -vocab[t])
        blocks = ranked[:4] + [f"{a}_{b}" for a, b in itertools.combinations(ranked[:5], 2)]
        return {f"{r[4]}_{b}" for b in blocks} or ({None} if null_blocks == "match" else set())

    def near(x, y):
        return None if None in (x, y) or max(x, y) == 0 else 1 - abs(x - y) / max(x, y)

    found = {}
    with_keys = [(r, keys(r), v) for r, v in zip(rows, vectors)]
    for (a, ka, va), (b, kb, vb) in itertools.product(with_keys, with_keys):
        if a[0] != "a" or b[0] != "b" or not ka & kb:
            continue
        sa, sb = " ".join(sorted(a[3].split())), " ".join(sorted(b[3].split()))
        fuzz = 2 * lcs(sa, sb) / (len(sa) + len(sb)) if sa or sb else 1.0
        ta, tb = set(toks(a[3])), set(toks(b[3]))
        jacc = len(ta & tb) / len(ta | tb) if ta | tb else 0.0
        quantity, price = near(a[5], b[5]), near(a[6], b[6])
        if quantity is None or price is None:
            score = None
        else:
            score = round(0.35 * float(np.dot(va, vb)) + 0.25 * fuzz + 0.1 * jacc + 0.25 * quantity**2 + 0.05 * price, 9)
        found[a[1], b[1]] = score
    return found


def product(side, i, name, own=False, quantity=1.0, price=2.0):
    return (side, i, f"http://{side}/{i}", name, own, quantity, price, f"Name: {name}; Quantity: {quantity}kg; Ingredients: ")


def catalogue(seed, size=40):
    draw = random.Random(seed)
    words = ["kaas", "melk", "jong", "oud", "belegen", "brie", "yoghurt", "vla", "boter", "x_y", "room", "geit", "halfvol", "mager", "bio", "kwark"]
    rows = []
    for i in range(size):
        name = " ".join(draw.choice(words) for _ in range(draw.randint(1, 6)))
        rows.append(product(draw.choice("ab"), i, name, draw.random() < 0.3, draw.choice([0.5, 1.0, 1.5, None]), draw.choice([1.0, 1.25, 2.0])))
    return rows


def check(spark, rows, null_blocks="match"):
    df = spark.createDataFrame(rows, SCHEMA)
    ready = matching.prepare(df, null_blocks=null_blocks)
    want = expected(rows, null_blocks)
    every = matching.expand_pairs(plan.scored_pairs(ready, None), ready.members)
    listed = [(r["product_id_a"], r["product_id_b"], r["score"]) for r in every.collect()]
    assert len(listed) == len(want)
    assert all(s == want[a, b] or abs(s - want[a, b]) < 2e-9 for a, b, s in listed)
    high = matching.expand_pairs(plan.scored_pairs(ready), ready.members).collect()
    assert {(r["product_id_a"], r["product_id_b"]) for r in high} == {p for p, s in want.items() if s is not None and s > 0.6}
    best = {r["product_id_a"]: (r["product_id_b"], r["score"]) for r in plan.best_of(ready).collect()}
    wanted = {}
    for (a, b), s in sorted(want.items()):
        if s is not None and s > 0.6 and (a not in wanted or s > wanted[a][1]):
            wanted[a] = (b, s)
    assert {a: b for a, (b, _) in best.items()} == {a: b for a, (b, _) in wanted.items()}
    return want


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_scores_and_best_matches(spark, seed):
    assert check(spark, catalogue(seed, 60))


def test_underscore_tokens_meet_pair_keys(spark):
    rows = [product("a", i, "foo_bar kaas") for i in range(3)] + [product("b", 10 + i, "foo bar") for i in range(3)]
    rows += [product("ab"[i % 2], 100 + i, f"vul{i} woord{i}") for i in range(34)]
    want = check(spark, rows, "drop")
    assert (0, 10) in want  # the token foo_bar and the pair foo, bar make the same key


def test_products_without_tokens(spark):
    rows = [product("a", 1, "zzz"), product("a", 2, "yyy"), product("b", 3, "zzz"), product("b", 4, "", True)]
    assert set(check(spark, rows)) == {(1, 3), (1, 4), (2, 3), (2, 4)}
    assert check(spark, rows, "drop") == {}


def test_hot_block_is_split_into_cells(spark, monkeypatch):
    monkeypatch.setattr(matching, "MIN_CELL_ROWS", 3)
    rows = [product("ab"[i % 2], i, f"kaas nummer{i}", price=1.0 + i) for i in range(24)]
    rows += [product("ab"[i % 2], 100 + i, f"ander{i}") for i in range(100)]
    ready = matching.prepare(spark.createDataFrame(rows, SCHEMA), null_blocks="drop")
    pairs = matching.candidate_pairs(ready.profiles)
    assert "cell_a" in pairs._jdf.queryExecution().toString()
    found = [(r["product_id_a"], r["product_id_b"]) for r in pairs.collect()]
    assert sorted(found) == sorted((a, b) for a in range(0, 24, 2) for b in range(1, 24, 2))
    check(spark, rows, "drop")


def test_a_third_of_equal_copies_is_scored_once(spark):
    rows = [product("ab"[i % 2], i, "jonge kaas plak") for i in range(40)]
    rows += catalogue(5, 160)[40:]
    ready = matching.prepare(spark.createDataFrame(rows, SCHEMA))
    pairs = plan.scored_pairs(ready).where("name_only_a = 'jonge kaas plak' and name_only_b = 'jonge kaas plak'").collect()
    assert [(r["product_id_a"], r["product_id_b"], r["copies_a"], r["copies_b"]) for r in pairs] == [(0, 1, 20, 20)]
    best = plan.best_of(ready).where("name_only_a = 'jonge kaas plak'").collect()
    assert sorted(r["product_id_a"] for r in best) == list(range(0, 40, 2))  # each copy gets its row
    assert {r["product_id_b"] for r in best} == {1}


def test_one_row_per_href(spark):
    rows = [product("a", 1, "oude kaas"), product("a", 2, "oude kaas", price=4.0), product("b", 3, "oude kaas", price=4.0)]
    rows = [(*r[:2], "http://same" if r[0] == "a" else r[2], *r[3:]) for r in rows]
    best = plan.match(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["href"], r["product_id_a"], r["product_id_b"]) for r in best] == [("http://same", 2, 3)]


@pytest.mark.parametrize("threshold", [None, K.PAIR_THRESHOLD])
def test_pairs_are_scored_in_their_cells(spark, threshold):
    """No pair is shuffled or joined to fetch what it is scored on: the last join is that of the cells."""
    ready = matching.prepare(spark.createDataFrame(catalogue(3, 60), SCHEMA))

    plan_text = plan.scored_pairs(ready, threshold)._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in plan_text.splitlines() if "Join " in line)
    assert "cell_a" in last  # it was a join by product_id_b, of the pairs with all that side a had brought


def test_rows_of_a_repeated_id_all_meet(spark):
    rows = [product("a", 1, "oude kaas"), product("a", 1, "oude kaas"), product("b", 2, "oude kaas")]
    ready = matching.prepare(spark.createDataFrame(rows, SCHEMA))
    n = ready.profiles.where("product_id = 1").count()
    assert plan.scored_pairs(ready).count() == n * n  # each row of the profile with the columns of each
    assert [(r["product_id_a"], r["product_id_b"]) for r in plan.best_of(ready).collect()] == [(1, 2)]


def test_repeats_of_a_row_follow_the_cluster_not_the_block(spark):
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n in (20_000, 60_000):
        rows = spark.range(2 * n).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("side"), F.lit("k").alias("block_key"))
        laid = matching.layout(rows, None)
        assert math.ceil(n / laid.cell_rows) <= math.isqrt(matching.CELLS_PER_TASK * shuffle)


def test_packed_products_equal_those_of_the_arrays(spark):
    rows = [([0.5, 0.25], [1.0, 0.1]), ([0.3, 0.7], [0.2, 0.9]), (None, [1.0, 2.0])]
    for kind, numbers in (("float", "float32"), ("double", "float64")):
        pairs = spark.createDataFrame(rows, f"x array<{kind}>, y array<{kind}>")
        both = pairs.select(similarity.packed(F.col("x")).alias("p"), similarity.packed(F.col("y")).alias("q"), "x", "y").select(
            similarity.packed_product(F.col("p"), F.col("q"), numbers).alias("packed"), similarity.dot_product(F.col("x"), F.col("y")).alias("plain")
        ).collect()
        assert [r.packed for r in both] == [r.plain for r in both]
        assert [r.packed is None for r in both] == [False, False, True]


def test_no_staged_table_keeps_the_texts(spark):
    begun = staging.mark(spark)
    matching.prepare(spark.createDataFrame(catalogue(1), SCHEMA))
    left = [path for path in staging.since(spark, begun) if os.path.exists(path)]
    assert left and all("product_text" not in spark.read.parquet(path).columns for path in left)


def test_the_match_threshold_prunes_the_pairs_of_predicted_matches(spark, monkeypatch):
    """Pairs that cannot be predicted are not made, and what is predicted is the same as from all best pairs."""
    rows = spark.createDataFrame(catalogue(7, 60), SCHEMA)
    every = prices.predicted_pairs(plan.match(rows)).collect()
    given = []
    monkeypatch.setattr(plan, "scored_pairs", lambda ready, threshold=K.PAIR_THRESHOLD: given.append(threshold) or matching.score_pairs(ready.profiles, threshold))
    found = plan.predicted(rows).collect()
    assert given == [K.MATCH_THRESHOLD]
    assert every and sorted(map(str, found)) == sorted(map(str, every))


def test_texts_are_not_written_and_not_shuffled_where_the_scan_has_tasks(spark, tmp_path, monkeypatch):
    """A text is most of a row: it is read again for the encoder. With few splits the texts are dealt, with the same result."""
    spark.createDataFrame(catalogue(9, 80), SCHEMA).repartition(8).write.parquet(str(tmp_path / "products"))
    products = spark.read.parquet(str(tmp_path / "products")).repartition(8, "product_id")
    written, plans = {}, []
    whole, encode = matching.stage, matching.encode
    monkeypatch.setattr(matching, "stage", lambda df, name: written.setdefault(name, df.columns) and whole(df, name))
    monkeypatch.setattr(matching, "encode", lambda df, *given: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or encode(df, *given))
    spread = matching.prepare(products).profiles
    dealt = matching.prepare(products.coalesce(1)).profiles
    assert all("product_text" not in columns for columns in written.values())
    assert ["RepartitionByExpression [side" in p for p in plans] == [False, True]
    assert sorted(map(str, spread.collect())) == sorted(map(str, dealt.collect()))


def test_profile_keys_are_short(spark):
    """Key rows carry the keys of both profiles through the shuffle: 128 bits, not the 64 letters of a hash."""
    keys = matching.prepare(spark.createDataFrame(catalogue(1), SCHEMA)).profiles.select("profile_key")
    assert keys.distinct().count() == keys.count() and {len(r.profile_key) for r in keys.collect()} == {16}


def test_cells_are_as_large_as_all_blocks_together_allow(spark):
    """Many blocks of one size: cells cut to spread one block alone would repeat the rows of all of them."""
    n, blocks = 4_000, 32
    rows = spark.range(2 * n * blocks).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("side"), (F.col("id") % (2 * blocks) / 2).cast("int").cast("string").alias("block_key"))
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        laid = matching.layout(rows, None)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    assert laid.pairs == n * n * blocks
    assert math.ceil(n / laid.cell_rows) <= 4  # it was 13
    assert laid.cell_rows**2 <= matching.CELL_PAIRS
