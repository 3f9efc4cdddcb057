"""The vector store in the matching, and the streamed load with rejects."""

import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import matching
from shelfmatch.operators.embedding import HashedTokens
from shelfmatch.sources import vector_store
from shelfmatch.streaming.incremental import load_pages_with_rejects

SCHEMA = "side string, product_id long, href string, name_only string, own_brand boolean, quantity double, price double, product_text string"
PAGES = "page_id bigint, url string, html string, sub_cat string"


def stored(spark, path, encoder_id="e1"):
    return {r.vector_key: list(r.embedding) for r in vector_store.read(spark, path, encoder_id).collect()}


def test_only_new_texts_are_encoded(spark, tmp_path):
    path = str(tmp_path / "vectors")
    rows = [(side, i, f"h{i}", f"melk {i % 4}", False, 1.0, 2.0, f"Name: melk {i % 4}") for i, side in enumerate("ab" * 10)]
    rows[3] = (*rows[3][:7], None)

    def prepared(rows, **options):
        ready = matching.prepare(spark.createDataFrame(rows, SCHEMA), **options)
        return {(r.side, r.product_id): list(r.embedding) for r in ready.profiles.collect()}

    plain = prepared(rows)
    assert prepared(rows, store=path, encoder_id="e1") == plain
    first = stored(spark, path)
    assert len(first) == len({r[7] for r in rows}) == 5
    assert prepared(rows, store=path, encoder_id="e1") == plain and stored(spark, path) == first
    files = spark.read.parquet(f"{path}/*")
    assert files.count() == 5  # the second run has added nothing
    changed = [(*rows[0][:7], "Name: volle melk"), *rows[1:]]
    assert prepared(changed, store=path, encoder_id="e1") == prepared(changed)
    assert len(stored(spark, path)) == 6 and stored(spark, path).items() >= first.items()
    prepared(rows, store=path, encoder_id="e2")
    assert len(stored(spark, path, "e2")) == 5 and not stored(spark, path, "e2").keys() & first.keys()
    with pytest.raises(ValueError, match="encoder"):
        prepared(rows, store=path)


def test_a_key_stored_twice_counts_once(spark, tmp_path):
    path = str(tmp_path / "vectors")
    texts = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "product_text string")
    vector_store.add_missing(texts, path, "e1", HashedTokens)
    folder = vector_store._folder(path, "e1")
    spark.read.parquet(folder).collect()
    rows = spark.createDataFrame(spark.read.parquet(folder).collect(), vector_store.VECTORS)
    rows.write.mode("append").parquet(folder)  # as two runs at once would
    assert len(stored(spark, path)) == 2
    assert vector_store.with_vectors(texts, path, "e1", HashedTokens).count() == 4


def page(i, sub_cat, price='<span class="price-large">1</span><span class="price-small">25</span>'):
    return (i, f"http://s/{i}", f'<div class="title"><h1>Kaas {i}</h1></div><p class="subtitle">1 kg</p><div class="price">{price}</div>', sub_cat)


def test_streamed_load_keeps_rejects_and_can_be_repeated(spark, tmp_path):
    source, products, rejects, checkpoint = (str(tmp_path / n) for n in ("in", "products", "rejects", "check"))

    def found():
        good = {(r.href, r.sub_cat) for r in spark.read.parquet(products).collect()}
        bad = [(r.href, r.sub_cat, r.problem) for r in spark.read.parquet(rejects).orderBy("href").collect()]
        return good, bad

    spark.createDataFrame([page(1, "kaas"), page(2, "kaas", ""), page(3, None)], PAGES).coalesce(1).write.parquet(source)
    load_pages_with_rejects(spark, source, products, rejects, checkpoint, PAGES)
    assert found() == ({("http://s/1", "kaas"), ("http://s/3", None)}, [("http://s/2", "kaas", "no price")])
    spark.createDataFrame([page(4, "melk"), (5, "http://s/5", None, "melk"), (6, "http://s/6", "", "melk")], PAGES).coalesce(1).write.mode("append").parquet(source)
    load_pages_with_rejects(spark, source, products, rejects, checkpoint, PAGES)
    whole = found()
    assert whole[0] == {("http://s/1", "kaas"), ("http://s/3", None), ("http://s/4", "melk")} and [b[2] for b in whole[1]] == ["no price", "no title", "no title"]
    load_pages_with_rejects(spark, source, products, rejects, checkpoint, PAGES)
    assert found() == whole
    # a batch whose commit was lost is run again and replaces itself
    for name in ("1", ".1.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    load_pages_with_rejects(spark, source, products, rejects, checkpoint, PAGES)
    assert found() == whole and spark.read.parquet(products).where(F.col("batch") == 1).count() == 1
