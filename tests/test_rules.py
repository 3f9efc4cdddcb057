"""Edge rules: page scope, CSV by name, evaluation without positives or scores, overflow, narrow candidate rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch import constants as K
from shelfmatch.functions import html
from shelfmatch.operators import corpus, embedding, evaluation, labels, matching, ordered, pages
from shelfmatch.operators.embedding import HashedTokens
from shelfmatch.plans import matching as plan
from shelfmatch.sources import catalogues, staging
from tests.test_matching import SCHEMA, product


def on(spark, page, *columns):
    return spark.createDataFrame([(page,)], "html string").select(*columns).first()


def test_price_and_title_of_the_first_box(spark):
    page = ('<h1>Menu</h1><div class="title"><h1>Kaas</h1></div><div class="price"><span class="price-large">89</span></div>'
            '<div class="tile"><div class="price"><span class="price-large">2</span><span class="price-small">49</span></div></div>')
    found = on(spark, page, html.price(F.col("html")).alias("price"), html.title(F.col("html"), "title").alias("title"))
    assert (found.price, found.title) == (0.89, "Kaas")
    assert on(spark, '<span class="price-large">1</span>', html.price(F.col("html")).alias("p")).p is None


def test_ingredient_pieces_are_trimmed(spark):
    page = '<h3>Ingrediënten</h3><div class="body"><p>Ingrediënten: tarwe, <b> EI </b> zout&nbsp;<i>x</i></p></div></article>'
    assert on(spark, page, html.ingredients(F.col("html")).alias("i")).i == "tarwe,EIzoutx"


def test_csv_is_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,extra,href\nKaas,1,http://s/1\n")
    row = catalogues.read_csv(spark, str(tmp_path / "a.csv"), "href string, name string, price double").first()
    assert tuple(row) == ("http://s/1", "Kaas", None)
    with pytest.raises(ValueError, match="price"):
        catalogues.read_csv(spark, str(tmp_path / "a.csv"), "href string, price double", strict=True)


def test_evaluation_without_positives_and_with_unknown_scores(spark):
    none = spark.createDataFrame([(0.9, 0), (0.2, 0)], "score double, label int")
    assert evaluation.pr_auc(none).first().pr_auc is None and evaluation.roc_auc(none).first().roc_auc is None
    assert {r.recall for r in evaluation.pr_curve(none).collect()} == {None, 0.0}
    gaps = spark.createDataFrame([(0.9, 1), (None, 1), (0.2, 0)], "score double, label int")
    found = evaluation.confusion_at(gaps, 0.5).first()
    assert (found.tp, found.fp, found.fn, found.recall) == (1, 0, 1, 0.5)


def test_equal_versions_have_a_defined_winner(spark):
    given = spark.createDataFrame([(1, 0)], "id int, label int")
    updates = spark.createDataFrame([(1, 1, 5), (1, 0, 5), (1, 1, 4)], "id int, label int, version long")
    assert labels.upsert_labels(given, updates, ["id"]).collect() == [(1, 1)]


def test_very_large_blocks_do_not_overflow(spark):
    rows = spark.createDataFrame([("a", "k", 4 * 10**9), ("b", "k", 4 * 10**9)], "side string, block_key string, copies long")
    assert matching.block_sizes(rows).first().n_pairs == 1.6e19
    scored = spark.createDataFrame([(0.5, 1), (0.4, 0)], "score double, label int")
    assert evaluation.roc_auc(scored).first().roc_auc == 1.0


def test_category_tree_of_pages_stored_twice(spark):
    site = [("http://s/", '<a class="department" href="/c/">c</a>'), ("http://s/c/", '<li><a href="/c/k/">k</a></li>'),
            ("http://s/c/k/", '<article><a class="top" href="/c/k/1">1</a></article>')]
    tree = pages.category_tree(spark.createDataFrame(site * 2, "url string, html string"), "http://s/").collect()
    assert tree == [("/c/", "/c/k/", "http://s/c/k/1")]


def test_each_profile_is_encoded_once(spark, tmp_path):
    path = str(tmp_path / "encoded")

    class Counted:
        def __call__(self, texts):
            with open(path, "a", encoding="utf-8") as file:
                file.write("x" * len(texts))
            return HashedTokens()(texts)

    rows = [product("ab"[i % 2], i, "jonge kaas plak") for i in range(40)] + [product("a", 50, "brie")]
    matching.prepare(spark.createDataFrame(rows, SCHEMA), make_encoder=Counted)
    with open(path, encoding="utf-8") as file:
        assert len(file.read()) == 3


def test_missing_columns_of_the_input(spark):
    with pytest.raises(ValueError, match="product_text"):
        matching.prepare(spark.createDataFrame([("a", 1)], "side string, product_id long"))


def test_replicated_rows_hold_no_text_and_no_vector(spark, monkeypatch):
    monkeypatch.setattr(matching, "MIN_CELL_ROWS", 5)
    rows = [product("ab"[i % 2], i, f"kaas nummer{i}", price=1.0 + i) for i in range(60)]
    rows += [product("ab"[i % 2], 100 + i, f"ander{i}") for i in range(300)]
    ready = matching.prepare(spark.createDataFrame(rows, SCHEMA), null_blocks="drop")
    pairs = matching.candidate_pairs(ready.profiles, 0.6)
    text = pairs._jdf.queryExecution().optimizedPlan().toString()
    grid = text[text.index("RepartitionByExpression"):]
    assert not any(name in grid.split("Relation")[0] for name in ("embedding", "name_only", "product_text"))
    every = matching.candidate_pairs(ready.profiles).select("product_id_a", "product_id_b").collect()
    assert len(every) == len(set(every)) == 900
    high = {(r.product_id_a, r.product_id_b) for r in plan.scored_pairs(ready).collect()}
    listed = {(r.product_id_a, r.product_id_b): r.score for r in plan.scored_pairs(ready, None).collect()}
    assert high == {p for p, s in listed.items() if s is not None and s > 0.6}


def test_one_token_with_a_separator_adds_keys_only_where_they_match(spark):
    rows = [product("a", i, "foo_bar kaas") for i in range(3)] + [product("b", 10 + i, "foo bar") for i in range(3)]
    rows += [product("ab"[i % 2], 100 + i, f"rood{i % 5} groen{i % 7} blauw{i % 6} geel{i % 8} zwart{i % 9} vul{i}") for i in range(60)]
    ready = matching.prepare(spark.createDataFrame(rows, SCHEMA))
    sizes = {r.name_only: len(r["keys"]) for r in ready.profiles.collect()}
    assert max(n for name, n in sizes.items() if name.startswith("rood")) == K.SINGLE_TOKENS
    assert sizes["foo bar"] == 3


def test_slices_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SLICE_ROWS", 10)
    found = ordered.with_position(spark.range(1000), ["id"])
    assert [r.position for r in found.orderBy("id").collect()] == list(range(1000))


def test_staged_tables_can_be_cleared(spark):
    other = spark.newSession()
    before = staging.stage(other.range(3), "some")
    assert before.count() == 3 and staging.application_folder(spark) in before.inputFiles()[0]


def test_fixed_words():
    assert {"&", "1", "beste", "passiezaanlander", "en", "het", "van", "mini"} <= set(K.STOPWORDS) and len(set(K.STOPWORDS)) == 33
    assert math.isclose(sum(K.WEIGHTS.values()), 1.0) and K.PAIR_THRESHOLD == 0.6 and K.MATCH_THRESHOLD == 0.78
    assert K.MULTIPACK_FACTORS["cl"] == 0.01 and corpus.NULL_BLOCK == ""


def test_long_texts_are_encoded_in_batches_of_few_bytes(spark):
    def make_encoder():
        def encoder(texts):
            return np.array([[sum(map(len, texts))]] * len(texts), dtype=np.float32)

        return encoder

    texts = spark.range(0, 2000, 1, 1).select("id", F.repeat(F.lit("x"), 10_000).alias("product_text"))
    together = embedding.encode(texts, make_encoder=make_encoder).agg(F.max(F.col("embedding")[0])).first()[0]
    assert together < 2 * embedding.BATCH_BYTES  # 20 MB came at once
