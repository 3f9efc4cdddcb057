"""The pipeline's stages against brute force on the smallest tables, and the registered queries against their SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as repo
import corpus_pipeline
from shelfmatch.llm import simhash
from shelfmatch.llm.queries import ORACLES, QUERIES
from tests.llm.test_models import brute_similarity
from tests.llm.test_texts import brute_components, brute_lines, brute_print

FOLDER = "/root/testdata/sf0.001"


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontamination", "bpe"]
    assert set(QUERIES) | {"pipeline"} <= set(repo.queries()) and set(ORACLES) <= set(repo.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{FOLDER}/{file}'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns[:len(columns)] == columns
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert kept["language_id"] == before
    assert kept["line_dedup"] == {d: t for d, t, _, _ in brute_lines(sorted(before.items()))}
    roots = brute_components({d: brute_print(t) for d, t in kept["line_dedup"].items()}, 4)
    assert set(kept["simhash_dedup"]) == set(roots.values())
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {d for d, t in kept["simhash_dedup"].items() if not any(brute_similarity(t, i) >= 0.8 for i in items)}
    assert set(kept["decontamination"]) == clean and clean != set(kept["simhash_dedup"])
    assert kept["bpe"] == kept["decontamination"]
    assert docs.where("decoded <> text or size(ids) = 0 and text <> ''").isEmpty()
    assert simhash.near_duplicates(docs).where("doc_id <> component_id").isEmpty()


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_library_without_the_subpackage():
    """The registered queries of the rest need none of this subpackage."""
    for folder, _, files in os.walk(os.path.dirname(os.path.abspath(repo.__file__)) + "/shelfmatch"):
        if not folder.endswith("llm") and "__pycache__" not in folder:
            for name in (f for f in files if f.endswith(".py")):
                with open(os.path.join(folder, name), encoding="utf-8") as file:
                    assert "shelfmatch.llm" not in file.read()
