"""Column names and types of the raw order lines and of the star schema."""

from __future__ import annotations

# Raw header -> column name. The two date headers occur in two spellings.
COLUMN_NAMES = {
    "Type": "transaction_type",
    "Days for shipping (real)": "days_real",
    "Days for shipment (scheduled)": "days_scheduled",
    "Benefit per order": "profit_per_order",
    "Sales per customer": "sales_per_customer",
    "Delivery Status": "delivery_status",
    "Late_delivery_risk": "late_delivery_risk",
    "Category Id": "category_id",
    "Category Name": "category_name",
    "Customer City": "customer_city",
    "Customer Country": "customer_country",
    "Customer Id": "customer_id",
    "Customer Segment": "customer_segment",
    "Customer State": "customer_state",
    "Customer Zipcode": "customer_zipcode",
    "Department Id": "department_id",
    "Department Name": "department_name",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Market": "market",
    "Order City": "order_city",
    "Order Country": "order_country",
    "Order Customer Id": "order_customer_id",
    "order date (DateOrders)": "order_date",
    "Order Date (DateOrders)": "order_date",
    "Order Id": "order_id",
    "Order Item Cardprod Id": "product_card_id",
    "Order Item Discount": "discount_amount",
    "Order Item Discount Rate": "discount_rate",
    "Order Item Id": "order_item_id",
    "Order Item Profit Ratio": "profit_ratio",
    "Order Item Quantity": "quantity_ordered",
    "Sales": "sales_amount",
    "Order Item Total": "order_item_total",
    "Order Profit Per Order": "order_profit_per_order",
    "Order Region": "order_region",
    "Order State": "order_state",
    "Order Status": "order_status",
    "Product Card Id": "product_id",
    "Product Category Id": "product_category_id",
    "Product Name": "product_name",
    "Product Price": "product_price",
    "shipping date (DateOrders)": "shipping_date",
    "Shipping Date (DateOrders)": "shipping_date",
    "Shipping Mode": "shipping_mode",
}

# Personal and non-analytic headers that are dropped on load.
PII_COLUMNS = [
    "Customer Email",
    "Customer Password",
    "Customer Fname",
    "Customer Lname",
    "Customer Street",
    "Product Description",
    "Product Image",
    "Product Status",
]

# What stands in for a missing text or amount.
DEFAULT_TEXT = {
    "customer_zipcode": "UNKNOWN",
    "delivery_status": "Unknown",
    "order_status": "UNKNOWN",
    "shipping_mode": "Standard Class",
    "market": "UNKNOWN",
    "order_region": "UNKNOWN",
}
DEFAULT_ZERO = ["profit_per_order", "discount_rate", "discount_amount"]

# Texts that a CSV reader of the pandas family takes for a missing value.
MISSING_MARKS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Accepted date layouts, tried in this order. Dates with slashes have the month or the day first; a file's column has one of
# the two.
MONTH_FIRST = ["M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy"]
DAY_FIRST = ["d/M/yyyy H:mm", "d/M/yyyy H:mm:ss", "d/M/yyyy"]
YEAR_FIRST = [
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd[' ']['T']HH:mm:ss.[SSSSSS][SSS]",
]

# Texts of a set flag, in lower case.
SET_FLAGS = ["1", "1.0", "true"]

# Files of this kind print single-precision amounts with up to nine digits (59.99000168), so
# the scale is far below a cent. 16 digits before the point hold any currency's amounts; a sum of 10 billion such
# amounts still fits, and so does one times 13 digits of units.
MONEY = "decimal(24,8)"
RATE = "decimal(14,10)"

# Names by kind of number.
LONG_COLUMNS = [
    "order_item_id", "order_id", "order_customer_id", "product_id", "product_card_id",
    "customer_id", "category_id", "department_id", "product_category_id",
]
COUNT_COLUMNS = ["quantity_ordered", "days_real", "days_scheduled"]
MONEY_COLUMNS = [
    "product_price", "discount_amount", "sales_amount", "profit_per_order",
    "order_item_total", "order_profit_per_order", "sales_per_customer",
]
# Numbers that a stored line cannot do without; text in one of them rejects the line, text in
# another number column only leaves that column empty.
VITAL_NUMBERS = [
    "order_item_id", "order_id", "product_id", "customer_id", "quantity_ordered", "days_real",
    "days_scheduled", "product_price", "sales_amount", "profit_per_order", "discount_amount",
    "discount_rate",
]
DATE_COLUMNS = ["order_date", "shipping_date"]

# Columns of the three tables, in DDL order.
PRODUCT_COLUMNS = [
    "product_id", "product_name", "category_id", "category_name",
    "department_id", "department_name", "product_price",
]
CUSTOMER_COLUMNS = [
    "customer_id", "customer_segment", "customer_city",
    "customer_state", "customer_country", "customer_zipcode",
]
FACT_COLUMNS = [
    "order_item_id", "order_id", "order_date", "shipping_date", "product_id", "customer_id",
    "market", "order_region", "order_city", "order_country", "shipping_mode", "order_status",
    "quantity_ordered", "product_price", "discount_rate", "discount_amount", "sales_amount",
    "profit_per_order", "profit_ratio", "days_scheduled", "days_real", "delay_days",
    "delivery_status", "late_delivery_risk",
]

# NOT NULL columns of the DDL, besides the keys.
PRODUCT_REQUIRED = ["product_name", "category_name", "department_name", "product_price"]
CUSTOMER_REQUIRED = ["customer_segment"]
FACT_REQUIRED = [
    "order_id", "order_date", "product_id", "customer_id", "market", "order_region",
    "shipping_mode", "order_status", "quantity_ordered", "product_price", "discount_rate",
    "discount_amount", "sales_amount", "profit_per_order", "days_scheduled", "days_real",
    "delay_days", "delivery_status", "late_delivery_risk",
]

# Where a line stood in its source; orders copies of one line ("first wins").
SOURCE_POSITION = "_source_position"

# Readings of slashed dates with the day first, until a vote has settled which one holds.
DAY_READING = "_day_first"

# Raw text of a record that does not have the header's number of fields.
MALFORMED = "_corrupt_record"
