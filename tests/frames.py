"""Small hand-made tables."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tidelane.star import Star

FACT_SCHEMA = (
    "order_item_id long, order_id long, order_date timestamp_ntz, shipping_date timestamp_ntz, product_id long, "
    "customer_id long, market string, order_region string, shipping_mode string, order_status string, "
    "quantity_ordered int, product_price decimal(18,4), discount_rate decimal(9,4), discount_amount decimal(18,4), "
    "sales_amount decimal(18,4), profit_per_order decimal(18,4), days_scheduled int, days_real int, delay_days int, "
    "delivery_status string, late_delivery_risk int"
)
NAMES = [part.split()[0] for part in FACT_SCHEMA.split(", ")]


def line(item: int, **given) -> tuple:
    row = {
        "order_item_id": item, "order_id": item, "order_date": datetime(2024, 1, 1), "shipping_date": None,
        "product_id": 1, "customer_id": 1, "market": "Europe", "order_region": "West", "shipping_mode": "First Class",
        "order_status": "COMPLETE", "quantity_ordered": 1, "product_price": Decimal(10), "discount_rate": Decimal(0),
        "discount_amount": Decimal(0), "sales_amount": Decimal(10), "profit_per_order": Decimal(1),
        "days_scheduled": 2, "days_real": 2, "delivery_status": "Shipping on time", "late_delivery_risk": 0,
    }
    for key, value in given.items():
        row[key] = Decimal(str(value)) if isinstance(row.get(key), Decimal) and value is not None else value
    if row["days_real"] is not None and row["days_scheduled"] is not None:
        row["delay_days"] = row["days_real"] - row["days_scheduled"]
    else:
        row["delay_days"] = None
    return tuple(row[n] for n in NAMES)


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def star(spark, rows, products=None, customers=None) -> Star:
    wanted = products or sorted({r[NAMES.index("product_id")] for r in rows})
    people = customers or sorted({r[NAMES.index("customer_id")] for r in rows})
    return Star(
        fact(spark, rows),
        spark.createDataFrame(
            [(p, f"item {p}", f"cat {p % 2}", "dep", Decimal(10)) for p in wanted],
            "product_id long, product_name string, category_name string, department_name string, "
            "product_price decimal(18,4)",
        ),
        spark.createDataFrame(
            [(c, f"segment {c % 3}") for c in people], "customer_id long, customer_segment string"
        ),
    )


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def by(df, *keys) -> dict:
    out = {}
    for r in rows(df):
        k = tuple(r[x] for x in keys)
        out[k[0] if len(k) == 1 else k] = r
    return out
