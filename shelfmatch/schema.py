"""Declared schemas of the sources, as DDL; nothing is inferred."""

CRAWL_LIST = "cat string, sub_cat string, product string"

# Shop with portion texts. Numbers are read as text, as an appended file may repeat its header line.
RAW_TEXT = (
    "href string, sub_cat string, name string, price string, portion string, ingredients string, nutrients string,"
    " kcal string, carbs_g string, fat_g string, protein_g string, salt_g string"
)

EMBEDDINGS = "product_id bigint, embedding array<float>"
PAGES = "page_id bigint, url string, html string"
LABELS = "product_id_a bigint, product_id_b bigint, name_a string, name_b string, label int"


def raw_fields(*price_columns: str) -> str:
    """Shop with size fields and one price column per snapshot date, in file order."""
    prices = "".join(f" `{c}` double," for c in price_columns)
    return (
        f"prod_desc string,{prices} quantity_value double, quantity_unit string, ingredients string, labels string,"
        " nutrients string"
    )
