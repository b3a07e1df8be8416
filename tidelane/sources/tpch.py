"""Order lines and star schema from TPC-H shaped tables.

The tables have no promise, no real delivery days and no missing values; the mapping derives
them from the columns that are there, the same way for every row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.operators.cleaning import dedupe_order_items
from tidelane.operators.star import build_fact_orders
from tidelane.schema import MONEY, RATE, SOURCE_POSITION
from tidelane.star import Star

# order priority -> (shipping mode, promised days)
_MODES = {"1-URGENT": ("Same Day", 0), "2-HIGH": ("First Class", 1), "3-MEDIUM": ("Second Class", 2)}
_OTHER_MODE = ("Standard Class", 4)

# columns that order the copies of a line
_POSITION = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _by_priority(i: int) -> Column:
    out = None
    for priority, values in _MODES.items():
        test = F.col("o_orderpriority") == priority
        out = F.when(test, values[i]) if out is None else out.when(test, values[i])
    return out.otherwise(_OTHER_MODE[i])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged_lines(spark: SparkSession, folder: str, unique: bool = False) -> DataFrame:
    """Typed order lines as they come, copies of a line included, or unique lines.

    Copies are removed from the narrow line table, before the joins and the derived amounts. Orders meet their customers
    before the lines, of which there are many more, so lines are shuffled for their order and their part only; the names of
    nations and regions, two tables of fixed size, come last. Unique lines, which the star is made of, end up by product, the
    key that most analyses sum by. Lines with copies meet their parts first: a part adds fewer columns to the second shuffle
    than an order with its customer, and lines of an order end up side by side, which packs the files written from them.
    Their number follows from their order's, so it is made after the joins.
    Precisions are chosen so that every amount fits the 18 digits that Spark keeps in a long.
    """
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    line, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    placed = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    its_order, its_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    if unique:
        line = dedupe_order_items(line.withColumn("order_item_id", number), [F.col(c) for c in _POSITION])
        number = F.col("order_item_id")
        whole = line.join(placed, its_order).join(part, its_part)
    else:
        whole = line.join(part, its_part).join(placed, its_order)
    joined = whole.join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    rate = F.col("l_discount").cast("decimal(3,2)")
    returned = F.when(F.col("l_returnflag") == "R", F.lit(Decimal("0.45"))).otherwise(F.lit(Decimal("0.00")))
    margin = (F.lit(Decimal("0.30")) - rate - rate - returned).cast("decimal(5,2)")
    promised = _by_priority(1)
    days = F.pmod(F.datediff("l_shipdate", "o_orderdate"), F.lit(7))
    status = (
        F.when(days > promised, "Late delivery").when(days == promised, "Shipping on time").otherwise("Advance shipping")
    )
    sales = (price * (F.lit(Decimal("1.00")) - rate).cast("decimal(5,2)")).cast(MONEY)
    return joined.select(
        F.struct(*_POSITION).alias(SOURCE_POSITION),
        number.alias("order_item_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("shipping_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("r_name").alias("market"),
        F.col("n_name").alias("order_region"),
        F.lit(None).cast("string").alias("order_city"),
        F.col("n_name").alias("order_country"),
        _by_priority(0).alias("shipping_mode"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_quantity").cast("int").alias("quantity_ordered"),
        F.col("p_retailprice").cast(MONEY).alias("product_price"),
        rate.cast(RATE).alias("discount_rate"),
        (price * rate).cast(MONEY).alias("discount_amount"),
        sales.alias("sales_amount"),
        (price * margin).cast(MONEY).alias("profit_per_order"),
        F.try_divide((price * margin).cast("double"), sales.cast("double")).alias("profit_ratio"),
        promised.alias("days_scheduled"),
        days.alias("days_real"),
        status.alias("delivery_status"),
        F.when(days > promised, 1).otherwise(0).alias("late_delivery_risk"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.lit(None).cast("string").alias("customer_city"),
        F.lit(None).cast("string").alias("customer_state"),
        F.col("n_name").alias("customer_country"),
        F.col("p_name").alias("product_name"),
        F.lit(None).cast("long").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.lit(None).cast("long").alias("department_id"),
        F.col("p_brand").alias("department_name"),
        # the columns below drive the defects of the raw lines
        "l_tax",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
        "c_name",
        "c_acctbal",
        "c_nationkey",
    )


def tpch_star(spark: SparkSession, folder: str) -> Star:
    """Unique lines with a promise of at least one day, and the two dimensions."""
    unique = staged_lines(spark, folder, unique=True)
    promised = unique.withColumn("days_scheduled", F.greatest(F.lit(1), F.col("days_scheduled")))
    fact = build_fact_orders(promised.withColumn("delay_days", F.col("days_real") - F.col("days_scheduled")))
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lit(None).cast("long").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.lit(None).cast("long").alias("department_id"),
        F.col("p_brand").alias("department_name"),
        F.col("p_retailprice").cast(MONEY).alias("product_price"),
    )
    customers = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.lit(None).cast("string").alias("customer_city"),
            F.lit(None).cast("string").alias("customer_state"),
            F.col("n_name").alias("customer_country"),
            F.lit(None).cast("string").alias("customer_zipcode"),
        )
    )
    return Star(fact, products, customers)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All lines as text under the raw headers, with gaps and faults that follow from other
    columns of the line (tax rate, quantity, account balance)."""
    tax = F.col("l_tax").cast("decimal(4,2)")
    quantity = F.col("l_quantity").cast("int")

    def text(c) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("string")

    def amount(c: str) -> Column:
        return F.col(c).cast("decimal(18,4)").cast("string")

    def absent_if(condition: Column, value: Column) -> Column:
        return F.when(~condition, value)

    date = lambda c: F.date_format(c, "M/d/yyyy H:mm")
    nothing = F.lit(None).cast("string")
    return staged_lines(spark, folder).select(
        SOURCE_POSITION,
        text("l_linestatus").alias("Type"),
        F.when(tax == 0.06, "-2").otherwise(text("days_real")).alias("Days for shipping (real)"),
        absent_if(quantity == 7, text("days_scheduled")).alias("Days for shipment (scheduled)"),
        absent_if(quantity == 4, amount("profit_per_order")).alias("Benefit per order"),
        amount("sales_amount").alias("Sales per customer"),
        absent_if(quantity == 1, F.col("delivery_status")).alias("Delivery Status"),
        F.when(quantity == 8, "1.0")
        .when(quantity == 9, "Y")
        .when(quantity != 10, text("late_delivery_risk"))
        .alias("Late_delivery_risk"),
        nothing.alias("Category Id"),
        F.col("category_name").alias("Category Name"),
        nothing.alias("Customer City"),
        F.col("customer_country").alias("Customer Country"),
        text("customer_id").alias("Customer Id"),
        F.col("customer_segment").alias("Customer Segment"),
        nothing.alias("Customer State"),
        absent_if(F.col("c_acctbal") < 0, F.lpad(text("c_nationkey"), 5, "0")).alias("Customer Zipcode"),
        nothing.alias("Department Id"),
        F.col("department_name").alias("Department Name"),
        nothing.alias("Latitude"),
        nothing.alias("Longitude"),
        absent_if(tax == 0.01, F.col("market")).alias("Market"),
        nothing.alias("Order City"),
        F.col("order_country").alias("Order Country"),
        text("customer_id").alias("Order Customer Id"),
        F.when((tax == 0.07) & (F.col("l_returnflag") == "R"), "13/13/2018 1:00")
        .otherwise(date("order_date"))
        .alias("order date (DateOrders)"),
        text("order_id").alias("Order Id"),
        text("product_id").alias("Order Item Cardprod Id"),
        absent_if(tax == 0.03, amount("discount_amount")).alias("Order Item Discount"),
        absent_if(tax == 0.03, amount("discount_rate")).alias("Order Item Discount Rate"),
        text("order_item_id").alias("Order Item Id"),
        nothing.alias("Order Item Profit Ratio"),
        F.when(tax == 0.04, "-1")
        .when(tax == 0.05, F.concat(text("quantity_ordered"), F.lit(".7")))
        .otherwise(text("quantity_ordered"))
        .alias("Order Item Quantity"),
        F.when(quantity == 5, "-5").when(quantity != 6, amount("sales_amount")).alias("Sales"),
        amount("sales_amount").alias("Order Item Total"),
        amount("profit_per_order").alias("Order Profit Per Order"),
        absent_if(quantity == 3, F.col("order_region")).alias("Order Region"),
        nothing.alias("Order State"),
        absent_if(quantity == 2, F.col("order_status")).alias("Order Status"),
        text("product_id").alias("Product Card Id"),
        nothing.alias("Product Category Id"),
        F.col("product_name").alias("Product Name"),
        absent_if(tax == 0.08, amount("product_price")).alias("Product Price"),
        F.when((tax == 0.07) & (F.col("l_returnflag") == "A"), "unknown")
        .otherwise(date("shipping_date"))
        .alias("shipping date (DateOrders)"),
        absent_if(tax == 0.02, F.col("shipping_mode")).alias("Shipping Mode"),
        F.concat("c_name", F.lit("@example.com")).alias("Customer Email"),
        F.lit("XXXXXXXXX").alias("Customer Password"),
        F.col("c_name").alias("Customer Fname"),
        F.col("c_name").alias("Customer Lname"),
        nothing.alias("Customer Street"),
        nothing.alias("Product Description"),
        nothing.alias("Product Image"),
        F.lit("0").alias("Product Status"),
    )
