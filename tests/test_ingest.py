"""CSV load: null words, padding, bad rows, header echoes, copies."""

from __future__ import annotations

from decimal import Decimal

import pytest

from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.sources.csv_files import land_csv, load_csv, read_csv_text, write_csv
from ledgerloom.sources.schemas import RAW_TABLES, typed_schema

HEADER = "product_id,product_name,category,price,currency,stock_quantity\n"


@pytest.fixture
def write(tmp_path):
    def put(name: str, text: str) -> str:
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(text)
        return str(folder)

    return put


def test_null_words_quotes_blanks_and_row_lengths(spark, write):
    path = write(
        "a.csv",
        HEADER
        + " P1 , Lamp ,Home,10.50,USD,3\n"
        + '"P,2","says ""hi""",NULL,null,,4\n'
        + "P3,Short,Home\n"
        + "P4,Long,Home,1,USD,5,extra\n",
    )
    good, bad = load_csv(spark, path, "raw_products")
    rows = {r.product_id: r for r in good.collect()}
    assert bad.count() == 0
    assert rows["P1"].product_name == "Lamp" and rows["P1"].price == Decimal("10.50")
    assert rows["P,2"].product_name == 'says "hi"'
    assert rows["P,2"].category is None and rows["P,2"].price is None
    assert rows["P,2"].currency is None
    assert rows["P3"].price is None and rows["P3"].stock_quantity is None
    assert rows["P4"].stock_quantity == 5
    assert good.drop("ingest_order").schema == typed_schema("raw_products")


def test_bad_rows_go_to_quarantine_and_none_is_lost(spark, write):
    path = write(
        "a.csv",
        HEADER
        + "P1,Lamp,Home,cheap,USD,3\n"
        + "P2,Lamp,Home,99999999999.999,USD,3\n"
        + "P" * 51
        + ",Lamp,Home,1,USD,3\n"
        + "Product_ID,product_name,CATEGORY,price,currency,stock_quantity\n"
        + "P5,Lamp,Home,1,USD,3\n",
    )
    good, bad = load_csv(spark, path, "raw_products")
    assert [r.product_id for r in good.collect()] == ["P5"]
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "bad_number:price",
        "bad_number:price",
        "header_echo",
        "too_long:product_id",
    ]
    assert good.count() + bad.count() == read_csv_text(spark, path, "raw_products").count()


def test_landing_keeps_both_parts(spark, write, tmp_path):
    path = write("a.csv", HEADER + "P1,Lamp,Home,x,USD,3\nP2,Lamp,Home,2,USD,3\n")
    good, bad = land_csv(spark, path, "raw_products", str(tmp_path / "out"))
    assert [r.product_id for r in good.collect()] == ["P2"]
    assert [r.price for r in bad.collect()] == ["x"]


def test_line_break_inside_quotes(spark, write):
    path = write("a.csv", HEADER + 'P1,"two\nlines",Home,1,USD,3\n')
    good, _ = load_csv(spark, path, "raw_products", multiline=True)
    assert [r.product_name for r in good.collect()] == ["two\nlines"]


def test_sample_shape_gives_one_row_per_customer(spark, write):
    """A file with its header repeated inside and all customers but one twice."""
    names = [f.name for f in RAW_TABLES["raw_customers"]]

    def line(i: int) -> str:
        return f"C{i},First{i},Last{i},c{i}@example.com,{i},Land\n"

    text = ",".join(names).upper() + "\n" + "".join(line(i) for i in range(2, 101))
    text += ",".join(names) + "\n" + "".join(line(i) for i in range(1, 101))
    path = write("customers.csv", text)
    good, bad = load_csv(spark, path, "raw_customers")
    assert bad.count() == 1 and good.count() == 199
    unique = first_per_key(good, ["customer_id"], "ingest_order")
    assert unique.count() == 100


def test_first_row_in_file_order_wins_and_rows_without_key_stay(spark, write):
    path = write("a.csv", HEADER + "P1,first,x,1,USD,1\nP1,second,x,2,USD,1\n,none,x,1,USD,1\n,none,x,1,USD,1\n")
    good, _ = load_csv(spark, path, "raw_products")
    kept = first_per_key(good, ["product_id"], "ingest_order").collect()
    assert sorted(r.product_name for r in kept) == ["first", "none", "none"]
    merged = first_per_key(good, ["product_id"], "ingest_order", keep_null_keys=False)
    assert merged.count() == 2


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'q"q', None)], "x string, y string, z string")
    write_csv(df, str(tmp_path / "o"))
    back = spark.read.options(header="true", escape='"').csv(str(tmp_path / "o")).collect()
    assert back[0].x == "a,b" and back[0].y == 'q"q' and back[0].z is None
