"""The label store: updates are seen whole or not at all."""

import pytest
from pyspark.sql import functions as F

from shelfmatch.sources import label_store

LABELS = "a bigint, b bigint, label int, note string"
UPDATES = LABELS + ", version bigint"
KEY = ["a", "b"]


def shown(frame):
    return {(r.a, r.b): (r.label, r.note) for r in frame.collect()}


def first(spark, folder, n=40):
    rows = [(i, i % 3, i % 2, None if i % 5 else "x") for i in range(n)]
    label_store.create(spark.createDataFrame(rows, LABELS).repartition(3), folder, KEY, buckets=8)
    return {(r[0], r[1]): (r[2], r[3]) for r in rows}


def updates(spark, rows):
    return spark.createDataFrame(rows, UPDATES)


def test_an_update_replaces_and_adds(spark, tmp_path):
    folder = str(tmp_path / "labels")
    expected = first(spark, folder)
    assert shown(label_store.read(spark, folder)) == expected
    before = label_store._manifest(spark, folder)["folders"]
    given = [(3, 0, 1, "late", 2), (3, 0, 0, "early", 1), (None, 7, 1, "no a", 1), (900, 1, None, None, 1)]
    assert label_store.update(updates(spark, given), folder) == 2
    changed = expected | {(3, 0): (1, "late"), (None, 7): (1, "no a"), (900, 1): (None, None)}
    assert shown(label_store.read(spark, folder)) == changed
    assert shown(label_store.read(spark, folder, 1)) == expected
    after = label_store._manifest(spark, folder)["folders"]
    assert 1 <= sum(before.get(b) != f for b, f in after.items()) <= 3  # the other buckets are not written again
    assert label_store.update(updates(spark, []), folder) == 2
    label_store.remove_unused(spark, folder)
    assert label_store.versions(spark, folder) == [2] and shown(label_store.read(spark, folder)) == changed


def test_a_killed_update_leaves_the_old_labels(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "labels")
    expected = first(spark, folder)
    rows = updates(spark, [(i, i % 3, 9, "new", 1) for i in range(40)])
    broken = rows.withColumn("label", F.when(F.col("a") == 31, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("label")))
    with pytest.raises(Exception, match="lost"):
        label_store.update(broken, folder)
    assert shown(label_store.read(spark, folder)) == expected

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(label_store, "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            label_store.update(rows, folder)
    assert shown(label_store.read(spark, folder)) == expected and label_store.versions(spark, folder) == [1]
    label_store.update(rows, folder)
    new = {k: (9, "new") for k in expected}
    assert shown(label_store.read(spark, folder)) == new
    label_store.remove_unused(spark, folder)
    assert len(list((tmp_path / "labels" / "data").glob("0*"))) == 1 and shown(label_store.read(spark, folder)) == new


def test_the_later_of_two_updates_fails(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "labels")
    expected = first(spark, folder)
    save = label_store._save

    def overtaken(*given):
        monkeypatch.setattr(label_store, "_save", save)
        label_store.update(updates(spark, [(1, 1, 5, "first", 1)]), folder)
        save(*given)

    monkeypatch.setattr(label_store, "_save", overtaken)
    with pytest.raises(RuntimeError, match="came first"):
        label_store.update(updates(spark, [(2, 2, 6, "second", 1)]), folder)
    assert shown(label_store.read(spark, folder)) == expected | {(1, 1): (5, "first")}
    label_store.update(updates(spark, [(2, 2, 6, "second", 1)]), folder)
    assert shown(label_store.read(spark, folder)) == expected | {(1, 1): (5, "first"), (2, 2): (6, "second")}


def test_empty_and_missing_stores(spark, tmp_path):
    folder = str(tmp_path / "labels")
    with pytest.raises(ValueError, match="no version"):
        label_store.read(spark, folder)
    label_store.create(spark.createDataFrame([], LABELS), folder, KEY)
    assert label_store.read(spark, folder).count() == 0
    with pytest.raises(ValueError, match="already"):
        label_store.create(spark.createDataFrame([], LABELS), folder, KEY)
    label_store.update(updates(spark, [(1, 1, 1, "x", 1)]), folder)
    assert shown(label_store.read(spark, folder)) == {(1, 1): (1, "x")}
