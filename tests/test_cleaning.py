from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.frames import by, rows
from tidelane.operators import cleaning, star
from tidelane.schema import COLUMN_NAMES, PII_COLUMNS, SOURCE_POSITION
from tidelane.sources.raw_orders import read_raw_orders


def test_personal_columns_go_and_absent_ones_do_not_matter(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`Customer Email` string, Market string, `Order Zipcode` string")
    out = cleaning.standardize_columns(cleaning.drop_pii(df))
    assert out.columns == ["market", "Order Zipcode"]
    assert len(PII_COLUMNS) == 8 and len(set(COLUMN_NAMES.values())) == 43


def test_either_spelling_of_a_date_header_works_but_not_both(spark):
    one = spark.createDataFrame([("x",)], "`Order Date (DateOrders)` string")
    assert cleaning.standardize_columns(one).columns == ["order_date"]
    both = spark.createDataFrame([("x", "y")], "`shipping date (DateOrders)` string, shipping_date string")
    with pytest.raises(ValueError):
        cleaning.standardize_columns(both)


def test_dates(spark):
    df = spark.createDataFrame([(1, "1/31/2018 22:56"), (2, "13/13/2018 1:00"), (3, "2018-02-03 04:05:06"), (4, None)], "i int, order_date string")
    got = by(cleaning.parse_timestamps(df), "i")
    assert got[1]["order_date"] == datetime(2018, 1, 31, 22, 56)
    assert got[2]["order_date"] is None and got[4]["order_date"] is None
    assert got[3]["order_date"] == datetime(2018, 2, 3, 4, 5, 6)


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        ("string", ["1", "1.0", "True", "Y", None, "0", " 1 ", ""], [1, 1, 1, 0, 0, 0, 1, 0]),
        ("double", [1.0, 2.0, None, 0.0], [1, 0, 0, 0]),
        ("int", [1, 2, None], [1, 0, 0]),
        ("boolean", [True, False, None], [1, 0, 0]),
    ],
)
def test_risk_flag(spark, kind, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, late_delivery_risk {kind}")
    got = by(cleaning.normalize_risk_flag(df), "i")
    assert [got[i]["late_delivery_risk"] for i in range(len(values))] == expected


def test_bounds(spark):
    schema = "i int, quantity_ordered double, product_price decimal(18,4), sales_amount decimal(18,4), days_real double, days_scheduled double"
    df = spark.createDataFrame(
        [(1, 2.7, Decimal("0.001"), Decimal(-4), 2.9, 0.0), (2, None, None, None, None, None), (3, -3.0, Decimal(5), Decimal(6), -2.0, 4.0)],
        schema,
    )
    got = by(cleaning.add_delay_days(cleaning.clamp_domains(df)), "i")
    pick = lambda r: [r[c] for c in ("quantity_ordered", "product_price", "sales_amount", "days_real", "days_scheduled", "delay_days")]
    assert pick(got[1]) == [2, Decimal("0.01"), 0, 2, 1, 1]
    assert pick(got[2]) == [1, Decimal("0.01"), 0, 0, 1, -1]
    assert pick(got[3]) == [1, 5, 6, 0, 4, -4]


def test_defaults(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), ("00725", "EU", Decimal("0.1"), "x")],
        "customer_zipcode string, market string, discount_rate decimal(9,4), shipping_mode string",
    )
    got = rows(cleaning.impute_defaults(df))
    assert got[0] == {"customer_zipcode": "UNKNOWN", "market": "UNKNOWN", "discount_rate": 0, "shipping_mode": "Standard Class"}
    assert got[1]["customer_zipcode"] == "00725"


def test_first_copy_wins_with_very_many_copies(spark):
    copies = spark.range(30000).select(
        F.lit(7).cast("long").alias("order_item_id"), F.col("id").alias(SOURCE_POSITION), (F.col("id") * 2).alias("x")
    )
    others = spark.range(100, 200).select(F.col("id").alias("order_item_id"), F.col("id").alias(SOURCE_POSITION), F.lit(-1).cast("long").alias("x"))
    got = by(cleaning.dedupe_order_items(copies.union(others)), "order_item_id")
    assert len(got) == 101 and got[7]["x"] == 0


def test_only_vital_numbers_reject_a_line(spark):
    df = spark.createDataFrame(
        [("1", "x", "59.99000168", "0.039999999"), ("2", "4.5", "abc", "0.1"), ("3", None, None, None)],
        "order_item_id string, latitude string, product_price string, discount_rate string",
    )
    got = by(cleaning.type_columns(df), "order_item_id")
    assert got[1][cleaning.REJECTED] == [] and got[1]["latitude"] is None
    assert got[1]["product_price"] == Decimal("59.99000168") and got[1]["discount_rate"] == Decimal("0.039999999")
    assert got[2][cleaning.REJECTED] == ["product_price"] and got[3][cleaning.REJECTED] == []


def test_lines_without_a_key_are_all_kept(spark):
    rows_ = [(None, 1), (None, 2), (None, 3), (5, 4), (5, 5)]
    df = spark.createDataFrame(rows_, f"order_item_id long, {SOURCE_POSITION} long")
    assert sorted(r[SOURCE_POSITION] for r in rows(cleaning.dedupe_order_items(df))) == [1, 2, 3, 4]


def test_dimension_takes_the_first_line(spark):
    lines = spark.createDataFrame(
        [(3, 2, 1, "late name", Decimal(9)), (1, 1, 1, "first name", Decimal(8)), (2, 5, 2, "other", Decimal(7))],
        f"order_item_id long, {SOURCE_POSITION} long, product_id long, product_name string, product_price decimal(18,4)",
    )
    got = by(star.build_dim_products(lines), "product_id")
    assert got[1]["product_name"] == "first name" and got[2]["product_price"] == 7 and len(got) == 2


HEADER = "Order Item Id,Order Id,Product Card Id,Customer Id,order date (DateOrders),Order Item Quantity,Market,Product Name,Customer Password,Late_delivery_risk,Product Price,Sales,Days for shipping (real),Days for shipment (scheduled),Delivery Status\n"


def _csv(tmp_path, name, lines, header=HEADER):
    path = tmp_path / name
    path.write_bytes((header + "".join(lines)).encode("latin-1"))
    return str(path)


def test_raw_file_to_clean_lines(spark, tmp_path):
    path = _csv(tmp_path, "orders.csv", [
        '1,10,5,7,1/31/2018 22:56,3,LATAM,"Caf\xe9 ""deluxe"", small",x,1,10.5,31.5,3,4,Advance shipping\n',
        "1,10,5,7,1/31/2018 22:56,9,LATAM,second copy,x,1,10.5,31.5,3,4,Advance shipping\n",
        "2,11,5,7,13/13/2018 22:56,3,LATAM,bad date,x,1,10.5,31.5,3,4,Advance shipping\n",
        "3,12,6,8,2/1/2018 0:01,many,NA,bad number,x,0,1,1,3,4,Late delivery\n",
        "4,13,6,8,2/1/2018 0:01,,NA,no market,x,,,,,,\n",
    ])
    raw = read_raw_orders(spark, path, position=True)
    assert raw.columns[:2] == ["Order Item Id", "Order Id"] and len(raw.columns) == 17
    staged = cleaning.stage_lines(raw)
    clean = by(cleaning.clean_lines(staged), "order_item_id")
    assert sorted(clean) == [1, 4]
    assert clean[1]["product_name"] == 'Caf\xe9 "deluxe", small' and clean[1]["quantity_ordered"] == 3
    assert clean[1]["delay_days"] == -1 and clean[1]["late_delivery_risk"] == 1
    assert clean[4]["market"] == "UNKNOWN" and clean[4]["delivery_status"] == "Unknown"
    assert (clean[4]["quantity_ordered"], clean[4]["product_price"], clean[4]["days_scheduled"]) == (1, Decimal("0.01"), 1)
    rejected = by(cleaning.rejected_lines(staged), "order_item_id")
    assert sorted(rejected) == [2, 3]
    assert rejected[3][cleaning.REJECTED] == ["quantity_ordered"]
    audit = rows(cleaning.etl_audit(raw, cleaning.clean_lines(staged), cleaning.rejected_lines(staged)))[0]
    assert audit["initial_rows"] == 5 and audit["cleaned_rows"] == 2 and audit["dropped_columns"] == 1


def test_a_file_with_another_header_fails(spark, tmp_path):
    _csv(tmp_path, "a.csv", ["1,2\n"], "Order Id,Market\n")
    _csv(tmp_path, "b.csv", ["1,2\n"], "Market,Order Id\n")
    with pytest.raises(Exception, match="CSV header"):
        read_raw_orders(spark, str(tmp_path)).collect()
