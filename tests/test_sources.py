"""Files in and out, resumed loads, the page stream and the category tree."""

import pytest
from pyspark.sql import functions as F

from shelfmatch import schema
from shelfmatch.operators import cleaning, pages
from shelfmatch.sources import catalogues, incremental, staging
from shelfmatch.streaming.incremental import load_new_pages

HEADER = "href,sub_cat,name,price,portion,ingredients,nutrients,kcal,carbs_g,fat_g,protein_g,salt_g\n"


def test_csv_with_a_repeated_header(spark, tmp_path):
    line = 'http://s/1,kaas,"Kaas, ""oud"" 500 g",3.49,500 g,MELK,,300,1,2,3,0.1\n'
    (tmp_path / "a.csv").write_text(HEADER + line + HEADER + line.replace("/1", "/2"))
    raw = catalogues.read_csv(spark, str(tmp_path / "a.csv"), schema.RAW_TEXT)
    assert raw.count() == 3 and raw.schema["price"].dataType.simpleString() == "string"
    clean = cleaning.clean_text_catalogue(raw).orderBy("href").collect()
    assert [(r["href"], r["name_only"], r["price"], r["quantity"], r["unit"]) for r in clean] == [
        ("http://s/1", 'Kaas, "oud"', 3.49, 0.5, "kg"), ("http://s/2", 'Kaas, "oud"', 3.49, 0.5, "kg"),
    ]


def test_field_catalogue_from_csv(spark, tmp_path):
    path = str(tmp_path / "b.csv")
    (tmp_path / "b.csv").write_text(
        "prod_desc,old,new,quantity_value,quantity_unit,ingredients,labels,nutrients\n"
        "AH Kaas 500 g,1.0,2.0,500,g,MELK,x,Per 100g\\300 kcal\\Vet30g\\x\nBorstel,1,1,1,stuk,,,\n"
    )
    raw = catalogues.read_csv(spark, path, schema.raw_fields("old", "new"))
    row, = cleaning.add_features(cleaning.clean_field_catalogue(raw, "new"), "b").collect()
    assert (row["name_only"], row["price"], row["quantity"], row["unit"], row["fat_g"]) == ("AH Kaas", 2.0, 0.5, "kg", 30.0)
    assert (row["price_per_unit"], row["own_brand"], row["vegan"]) == (4.0, True, False)


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "shop [1] a"
    folder.mkdir()
    (folder / "1.csv").write_text("href,name\nhttp://y,Melk\n")
    (folder / "2 {x}.csv").write_text("\nname,href,price\n\"Kaas, oud\",http://z,2.5\nBrood,http://w,x\n")
    (folder / "3.csv").write_text("href,name\nhttp://v,Sap\n")
    (folder / "4.csv").write_text("")
    path = str(tmp_path / "shop*a")

    def rows(columns, **options):
        return {tuple(r) for r in catalogues.read_csv(spark, path, columns, **options).collect()}

    names = {("http://y", "Melk"), ("http://z", "Kaas, oud"), ("http://w", "Brood"), ("http://v", "Sap")}
    assert rows("href string, name string") == rows("href string, name string", strict=True) == names
    assert rows("name string, price double") == {("Melk", None), ("Kaas, oud", 2.5), ("Brood", None), ("Sap", None)}
    with pytest.raises(ValueError, match="1.csv lacks the columns price"):
        rows("name string, price string", strict=True)
    with pytest.raises(Exception, match="(?i)malformed"):
        catalogues.read_csv(spark, str(tmp_path / "shop*a" / "2*"), "name string, price double", strict=True).collect()


def test_csv_without_lines(spark, tmp_path):
    (tmp_path / "1.csv").write_text("")
    assert catalogues.read_csv(spark, str(tmp_path), "href string, price double").collect() == []
    (tmp_path / "2.csv").write_text("")
    assert catalogues.read_csv(spark, str(tmp_path), "href string, price double").collect() == []


def test_csv_export_of_lists(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], "x,y")], "id int, tokens array<string>, t string")
    for _ in range(2):  # the second write replaces the first
        catalogues.write_csv(df, str(tmp_path / "out"))
    back = catalogues.read_csv(spark, str(tmp_path / "out"), "id int, tokens string, t string")
    assert [tuple(r) for r in back.collect()] == [(1, '["a","b"]', "x,y")]


def test_append_and_resume(spark, tmp_path):
    todo = spark.createDataFrame([("kaas", 1), ("kaas", 2), ("melk", 3)], "sub_cat string, id int")
    path = str(tmp_path / "raw")
    catalogues.append_table(todo.where("sub_cat = 'kaas'"), path)
    rest = incremental.remaining(todo, spark.read.parquet(path))
    assert [r["id"] for r in rest.collect()] == [3]
    catalogues.append_table(rest, path)
    assert spark.read.parquet(path).count() == 3
    assert {r["sub_cat"]: r["n_products"] for r in incremental.group_sizes(todo).collect()} == {"kaas": 2, "melk": 1}


def test_vectors_are_pruned_by_shop(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, [1.0]), ("b", 2, [0.5])], "shop string, product_id long, embedding array<float>")
    catalogues.write_vectors(df, str(tmp_path / "v"))
    one = catalogues.read_vectors(spark, str(tmp_path / "v"), "b")
    assert [tuple(r) for r in one.collect()] == [(2, [0.5])]
    assert "PartitionFilters: [isnotnull(shop" in one._jdf.queryExecution().toString()


def test_stage_reads_the_written_rows(spark):
    staged = staging.stage(spark.range(5).withColumn("t", F.array(F.lit("x"))), "t")
    assert staged.count() == 5 and "FileScan parquet" in staged._jdf.queryExecution().toString()
    assert "ResolvedHint" in staging.broadcast_if_small(staged, 5 * 48)._jdf.queryExecution().toString()
    assert "ResolvedHint" not in staging.broadcast_if_small(staged, 4 * 48)._jdf.queryExecution().toString()


def page(i, price='<span class="price-large">1</span><span class="price-small">25</span>'):
    return (i, f"http://s/kaas/{i}", f'<div class="title"><h1>Kaas {i}</h1></div><p class="subtitle">1 kg</p><div class="price">{price}</div>')


def test_stream_reads_each_page_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([page(1), page(2, "")], schema.PAGES).coalesce(1).write.parquet(source)
    load_new_pages(spark, source, target, checkpoint)
    spark.createDataFrame([page(3)], schema.PAGES).coalesce(1).write.mode("append").parquet(source)
    load_new_pages(spark, source, target, checkpoint)
    load_new_pages(spark, source, target, checkpoint)
    rows = spark.read.parquet(target).orderBy("href").collect()
    assert [(r["href"], r["price"], r["portion"]) for r in rows] == [("http://s/kaas/1", 1.25, "1 kg"), ("http://s/kaas/3", 1.25, "1 kg")]


def test_rejected_pages(spark):
    bad = '<ul class="nutrition"><div class="nutrition-item"><span>Vet</span><span>veel</span></div></ul>'
    rows = pages.product_rows(spark.createDataFrame([page(1), page(2, ""), (3, "http://s/3", "<p>x</p>"), (4, "http://s/4", page(4)[2] + bad)], schema.PAGES))
    assert {r["href"]: r["problem"] for r in pages.rejected_pages(rows).collect()} == {
        "http://s/kaas/2": "no price", "http://s/3": "no title", "http://s/4": "bad nutrient",
    }
    assert [r["href"] for r in pages.usable_products(rows).collect()] == ["http://s/kaas/1"]


def test_category_tree(spark):
    site = [
        (1, "http://s/start", '<a class="x department" href="/b/kaas">k</a><a class="department" href="/boodschappen/non-food">n</a><a href="/b/x">x</a>'),
        (2, "http://s/b/kaas", '<ul><li><a href="/b/kaas/jong">j</a></li><li><a href="/b/melk/vol">m</a></li></ul><a href="/b/kaas/oud">o</a>'),
        (3, "http://s/b/kaas/jong", '<article><a class="top" href="/b/kaas/jong/1">1</a><a href="/b/kaas/jong/2">2</a></article><article><a class="top" href="/b/ander/3">3</a></article>'),
        (4, "http://s/boodschappen/non-food", '<li><a href="/boodschappen/non-food/x">x</a></li>'),
    ]
    tree = pages.category_tree(spark.createDataFrame(site, schema.PAGES), "http://s/start")
    assert [tuple(r) for r in tree.collect()] == [("/b/kaas", "/b/kaas/jong", "http://s/b/kaas/jong/1")]
