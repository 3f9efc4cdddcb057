"""The plan from raw listings to the price comparison."""

from shelfmatch import schema
from shelfmatch.plans import matching as plan

PRICES = "price_2026_03_14"
TEXT = r"Per 100g\Energie (60 kcal)\Vet1,5g\Zout0,1g\x"


def raw(spark, rows_a, rows_b):
    a = [(i, f"http://s/{i}", "zuivel", name, price, portion, ingredients, None, "60", "1", "2", "3", "0.1") for i, name, price, portion, ingredients in rows_a]
    return (
        spark.createDataFrame(a, f"product_id bigint, {schema.RAW_TEXT}"),
        spark.createDataFrame(rows_b, f"product_id bigint, {schema.raw_fields(PRICES)}"),
    )


ROWS_A = [
    (1, "volle melk 1 liter", "1.50", "1 liter", "MELK"), (2, "bruin brood 800 gram", "2.00", "800 gram", 'meel, "water"\nzout'),
    (3, "appelsap 6 x 330 ml", "9.00", "6 x 330 ml", None), (4, "spons", "1.00", "stuk", None), (5, "zure haring", "x", "200 gram", ""),
]
ROWS_B = [
    (11, "volle melk 1 liter", 1.25, 1.0, "l", "MELK", "", TEXT), (12, "bruin brood 800 gram", 2.0, 800.0, "g", 'meel, "water"\nzout', "", TEXT),
    (13, "appelsap", 8.0, 1980.0, "ml", None, "", TEXT), (14, "borstel", 1.0, 1.0, "stuk", None, "", None), (15, "zure haring", 1.0, 200.0, "g", "", "", TEXT),
]


def test_catalogues_are_the_same_after_their_files(spark, tmp_path):
    given = raw(spark, ROWS_A, ROWS_B)
    straight = plan.cleaned_sides(*given, PRICES)
    handed = plan.cleaned_sides(*given, PRICES, str(tmp_path / "cleaned"))
    assert handed.columns == straight.columns
    rows = sorted(map(tuple, straight.collect()), key=str)
    assert sorted(map(tuple, handed.collect()), key=str) == rows
    by_id = {r[1]: r for r in rows}
    assert by_id.keys() == {1, 2, 3, 5, 11, 12, 13, 15}  # no portion, no nutrient text: no food
    assert by_id[3][5] == by_id[13][5] == 1.98 and by_id[5][6] is None and by_id[11][2] == "11"


def test_matched_and_compared(spark, tmp_path):
    # names that a third of all products share are no block keys, so the catalogues are filled up
    filled_a = ROWS_A + [(100 + i, f"artikel{i} soort{i}", "5.00", f"{i + 1} kilo", None) for i in range(20)]
    filled_b = ROWS_B + [(200 + i, f"waar{i} merk{i}", 9.0, 50.0 + i, "g", None, "", TEXT) for i in range(20)]
    given = raw(spark, filled_a, filled_b)
    pairs = {(r.product_id_a, r.product_id_b) for r in plan.match(plan.cleaned_sides(*given, PRICES)).where("score > 0.78").collect()}
    assert {(1, 11), (2, 12)} <= pairs and not any(a == 5 for a, _ in pairs)
    report = {r.scope: r for r in plan.compare_raw(*given, PRICES, str(tmp_path / "cleaned")).collect()}
    overall = report["Overall"]
    assert overall.cheaper_a + overall.equal + overall.cheaper_b == len(pairs) and overall.equal >= 1 and overall.cheaper_b >= 1


def test_empty_catalogues(spark, tmp_path):
    report = plan.compare_raw(*raw(spark, [], []), PRICES, str(tmp_path / "cleaned")).collect()
    assert [(r.scope, r.cheaper_a, r.equal, r.cheaper_b) for r in report] == [("Overall", 0, 0, 0), ("Own Brand", 0, 0, 0)]
