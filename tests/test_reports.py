"""Evaluation, sampling, labels, prices and exploration against hand-computed or brute-force values."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import eda, evaluation, labels, ordered, prices


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


def brute(rows, threshold):
    tp = sum(s >= threshold and y == 1 for s, y in rows)
    fp = sum(s >= threshold and y == 0 for s, y in rows)
    fn = sum(s < threshold and y == 1 for s, y in rows)
    part = lambda a, b: a / b if b else 0.0
    return part(tp, tp + fp), part(tp, tp + fn), part(2 * tp, 2 * tp + fp + fn)


@pytest.fixture(scope="module")
def sample():
    draw = random.Random(3)
    return [(round(draw.random(), 2), int(draw.random() < 0.4)) for _ in range(300)]


def test_small_curve(spark):
    rows = scored(spark, [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0), (0.7, None)])
    assert evaluation.roc_auc(rows).first()[0] == pytest.approx(0.625)
    assert evaluation.pr_auc(rows).first()[0] == pytest.approx(0.6667, abs=5e-5)
    curve = {(round(r["precision"], 6), r["recall"]) for r in evaluation.pr_curve(rows).collect()}
    assert curve == {(0.5, 0.5), (0.666667, 1.0), (0.5, 1.0), (1.0, 0.0)}


def test_roc_auc_counts_ordered_pairs(spark, sample):
    pos, neg = [s for s, y in sample if y], [s for s, y in sample if not y]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert evaluation.roc_auc(scored(spark, sample)).first()[0] == pytest.approx(wins / (len(pos) * len(neg)))


def test_sweep_and_best_threshold(spark, sample):
    sample = sample + [(0.29, 1), (0.57, 0), (0.58, 1), (1.0, 1), (-0.1, 1)]  # steps where i * 0.01 is not exact
    sweep = evaluation.threshold_sweep(scored(spark, sample))
    rows = sweep.orderBy("step").collect()
    assert [r["step"] for r in rows] == list(range(100))
    for r in rows:
        assert (r["precision"], r["recall"], r["f1"]) == pytest.approx(brute(sample, r["step"] * 0.01)), r["step"]
    top = max(rows, key=lambda r: (r["f1"], -r["step"]))
    assert evaluation.best_threshold(sweep).first()["step"] == top["step"]
    assert evaluation.sweep_tail(sweep).count() == 40
    found = evaluation.confusion_at(scored(spark, sample), 0.5).first()
    assert (found["precision"], found["recall"], found["f1"]) == pytest.approx(brute(sample, 0.5))


def test_no_labels_at_all(spark):
    rows = scored(spark, [(0.5, None)])
    assert evaluation.roc_auc(rows).first()[0] is None
    assert evaluation.threshold_sweep(rows).agg(F.max("f1")).first()[0] == 0.0


def test_positions_and_running_totals(spark):
    draw = random.Random(1)
    rows = [(i, draw.randint(0, 5), draw.randint(1, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, grp int, w long")
    found = {r["id"]: r["position"] for r in ordered.with_position(df, [F.desc("w"), "id"]).collect()}
    assert found == {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    running = {r["id"]: r["upto"] for r in ordered.running_totals(df, ["id"], {"upto": "w"}, within=("grp",)).collect()}
    for g in range(6):
        total = 0
        for i, _, w in (r for r in rows if r[1] == g):
            total += w
            assert running[i] == total


def test_sample_has_exact_sizes_and_repeats(spark):
    rows = spark.createDataFrame([(i, round(0.6 + i % 7 / 100, 2)) for i in range(300)], "id long, score double")
    first = labels.stratified_sample(rows, ["id"], draws=(10, 20, 10)).collect()
    again = labels.stratified_sample(rows, ["id"], draws=(10, 20, 10)).collect()
    assert sorted(first) == sorted(again) and len({r["id"] for r in first}) == 40
    place = {r[1]: n for n, r in enumerate(sorted(((-(0.6 + i % 7 / 100), i) for i in range(300)), key=lambda r: (round(r[0], 2), r[1])))}
    third = {"high": range(0, 100), "middle": range(100, 200), "low": range(200, 300)}
    assert all(place[r["id"]] in third[r["stratum"]] for r in first)
    assert sorted(r["stratum"] for r in first) == ["high"] * 10 + ["low"] * 10 + ["middle"] * 20
    other = labels.stratified_sample(rows, ["id"], draws=(10, 20, 10), seed=7).collect()
    assert sorted(first) != sorted(other)


def test_review_rows_are_numbered_by_third(spark):
    pairs = spark.createDataFrame([(i, 1 - i / 100, f"n{i}") for i in range(30)], "id long, score double, name string")
    drawn = labels.stratified_sample(pairs, ["id"], draws=(2, 3, 2))
    rows = labels.review_rows(drawn, pairs, ["id"]).orderBy("draw").collect()
    assert [r["draw"] for r in rows] == list(range(7))
    assert [r["stratum"] for r in rows] == ["high"] * 2 + ["middle"] * 3 + ["low"] * 2


def test_label_upsert_and_attach(spark):
    given = spark.createDataFrame([(1, 1), (2, None), (3, 0)], "id long, label int")
    updates = spark.createDataFrame([(2, 1, 1), (2, 0, 2), (4, 1, 1), (3, None, 1)], "id long, label int, version long")
    merged = labels.upsert_labels(given, updates, ["id"])
    assert {r["id"]: r["label"] for r in merged.collect()} == {1: 1, 2: 0, 3: None, 4: 1}
    pairs = spark.createDataFrame([(1,), (9,)], "id long")
    assert {r["id"]: r["label"] for r in labels.attach_labels(pairs, merged, ["id"]).collect()} == {1: 1, 9: None}


def test_price_report(spark):
    rows = [(1.0, 2.0, False), (2.0, 1.5, True), (3.0, 3.0, True), (2.0, 2.2, None), (0.0, 0.0, False)]
    report = prices.price_comparison(spark.createDataFrame(rows, "price_a double, price_b double, own_brand_a boolean"))
    found = {r["scope"]: r for r in report.collect()}
    overall, own = found["Overall"], found["Own Brand"]
    assert (overall["cheaper_a"], overall["equal"], overall["cheaper_b"]) == (2, 2, 1)  # outliers count here
    assert (own["cheaper_a"], own["equal"], own["cheaper_b"]) == (0, 1, 1)
    assert (overall["n_pairs"], own["n_pairs"]) == (3, 2)
    assert overall["mean_rel_diff"] == pytest.approx((-0.25 + 0 + 0.2 / 2.2) / 3)
    assert (own["total_a"], own["total_b"]) == (5.0, 4.5)
    assert own["verdict"] == "shop b is 12.5% cheaper on average"
    bars = {r["scope"]: (r["left_equal"], r["left_a"], r["left_b"]) for r in prices.wins_offsets(report).collect()}
    assert bars["Overall"] == (-1.0, -3.0, 1.0)


def test_empty_own_brand_keeps_its_row(spark):
    rows = spark.createDataFrame([(1.0, 2.0, False)], "price_a double, price_b double, own_brand_a boolean")
    found = {r["scope"]: (r["cheaper_a"], r["equal"], r["cheaper_b"]) for r in prices.wins_table(rows).collect()}
    assert found == {"Overall": (1, 0, 0), "Own Brand": (0, 0, 0)}


def test_median_and_density(spark):
    rows = [(0, float(p)) for p in (1, 2, 2, 3)] + [(1, float(p)) for p in (5, 1, 20)] + [(1, None)]
    df = spark.createDataFrame(rows, "shop int, price double")
    stats = {r["shop"]: (r["n_products"], r["mean_price"], r["median_price"]) for r in eda.price_stats(df).collect()}
    assert stats == {0: (4, 2.0, 2.0), 1: (4, pytest.approx(26 / 3), 5.0)}
    curve = eda.price_density(df).where("shop = 0").orderBy("point").collect()
    step = curve[1]["x"] - curve[0]["x"]
    assert len(curve) == 200 and sum(r["density"] for r in curve) * step == pytest.approx(1, abs=0.01)


def test_products_with_unknown_shares(spark):
    rows = spark.createDataFrame(
        [(1, 0.5, 0.2, 0.3, True), (2, None, 0.2, 0.3, False), (3, 1.2, 0.0, 0.1, False), (4, 0.1, 0.1, 0.25, False)],
        "id int, frac_kcal_carbs double, frac_kcal_fat double, frac_kcal_protein double, vegan boolean",
    )
    assert [r["id"] for r in eda.valid_products(rows).collect()] == [1, 4]
    shares = {r["threshold"]: r["share_non_vegan"] for r in eda.share_non_vegan(rows).collect()}
    assert shares == {0.0: 0.75, 0.2: pytest.approx(2 / 3)}
    assert [r["id"] for r in eda.top_products(rows, "frac_kcal_carbs", "id", 2).collect()] == [3, 1]
