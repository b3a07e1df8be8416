"""What the registered queries write, shuffle and send to the driver."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import registry
from tests.conftest import SMALL
from tests.frames import line, rows, star
from tests.test_plans import plan
from tidelane.functions.lineage import _RELEASE
from tidelane.operators import classify, inventory, revenue
from tidelane.schema import SOURCE_POSITION
from tidelane.sources.store import read_rollup, write_rollups, write_star
from tidelane.sources.tpch import raw_lines, staged_lines
from tidelane.star import Star, customer_rollup, daily_rollup, delivery_rollup, route_rollup, separate_rollups


@pytest.fixture
def folders(monkeypatch, tmp_path):
    """Queries start with nothing stored and write below one folder."""
    for name in ("_STORED", "_READ"):
        monkeypatch.setattr(registry, name, {})
    monkeypatch.setattr(registry, "shared_path", lambda spark, name: f"{tmp_path}/{name}")
    return tmp_path


def _tables(folder: Path) -> set[str]:
    return {p.name for p in folder.glob("star/*") if p.is_dir()}


STAR = {"fact_orders", "dim_products", "dim_customers"}


@pytest.mark.parametrize("name", ["reorder_point", "product_lead_time", "inventory_master", "abc_classify"])
def test_analyses_of_products_store_the_star_only(spark, folders, name):
    registry.queries()[name](spark, SMALL)
    assert _tables(folders) == STAR
    assert not [*folders.glob("star/fact_orders/order_year_month=*")]


def test_reports_store_the_tables_that_they_read(spark, folders):
    registry.queries()["az_sku_count"](spark, SMALL)
    registry.queries()["classification_roster"](spark, SMALL)
    assert _tables(folders) == STAR | {"inventory_abc_xyz_analysis"}


def test_constraints_of_faulty_lines_need_no_stored_star(spark, folders):
    registry.queries()["dq_constraints"](spark, SMALL)
    assert not (folders / "star").exists() and [*folders.glob("astray/*.parquet")]


def test_raw_files_are_packed(spark, folders):
    n = registry.queries()["read_raw_orders"](spark, SMALL).count()
    assert n == staged_lines(spark, SMALL).count()
    files = [*folders.glob("raw/part-*")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)


def _dealt(spark, lines) -> list[str]:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        return [d for d in plan(lines()).split("\n\n") if "Exchange" in d.split("\n")[0] and "hashpartitioning" in d]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_lines_are_shuffled_without_their_orders(spark):
    dealt = _dealt(spark, lambda: raw_lines(spark, SMALL).drop(SOURCE_POSITION))
    parts = [d for d in dealt if "hashpartitioning(l_partkey" in d]
    orders = [d for d in dealt if "hashpartitioning(l_orderkey" in d]
    assert len(parts) == len(orders) == 1
    assert "c_name" not in parts[0] and "p_name" not in parts[0]
    assert "c_name" not in orders[0] and "p_name" in orders[0]
    assert not any("order_item_id" in d for d in dealt)


def test_unique_lines_end_up_by_product(spark):
    dealt = _dealt(spark, lambda: staged_lines(spark, SMALL, unique=True).select("order_item_id", "market", "product_price"))
    assert ["c_nationkey" in d for d in dealt if "hashpartitioning(l_partkey" in d] == [True]


def test_raw_files_are_written_without_leaving_shuffle_files(spark, folders):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    kept = lambda: {f for d in env.blockManager().diskBlockManager().localDirsString() for f in Path(d).glob("*/shuffle_*")}
    settings, before = {s: spark.conf.get(s, None) for s in (_RELEASE, "spark.sql.autoBroadcastJoinThreshold")}, kept()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        n = registry.queries()["read_raw_orders"](spark, SMALL)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert settings == {s: spark.conf.get(s, None) for s in settings}
    until = time.monotonic() + 20
    while kept() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not kept() - before
    assert n.count() == staged_lines(spark, SMALL).count()


def _faulty(spark):
    return star(spark, [
        line(1, quantity_ordered=2), line(2, product_id=None, days_real=None), line(3, profit_per_order="-3.5", days_real=5),
        line(4, customer_id=7, order_date=None, discount_rate=None), line(5, market=None, sales_amount=None, days_scheduled=None),
        line(6, product_id=2, shipping_mode="Same Day", days_real=0),
    ], products=[1, 2], customers=[1, 7]).fact


def test_each_rollup_shuffles_its_own_columns(spark, tmp_path):
    fact = _faulty(spark)
    text = plan(separate_rollups(fact))
    assert "Expand" not in text
    daily = next(d for d in text.split("\n\n") if "Exchange" in d.split("\n")[0] and "hashpartitioning(product_id" in d and "order_day" in d)
    assert "squared" not in daily and "on_time" not in daily
    made = {"product_daily": daily_rollup, "product_routes": route_rollup, "delivery_months": delivery_rollup, "customer_orders": customer_rollup}
    assert rows(separate_rollups(fact).groupBy("rollup").count().orderBy("rollup")) == [
        {"rollup": name, "count": make(fact).count()} for name, make in sorted(made.items())
    ]
    write_star(Star(fact, fact.select("product_id"), fact.select("customer_id")), str(tmp_path), months=False)
    write_rollups(spark, str(tmp_path), apart=True)
    for name, make in made.items():
        got, wanted = read_rollup(spark, str(tmp_path), name), make(fact)
        assert got.dtypes == wanted.select(*got.columns).dtypes, name
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.select(*got.columns).collect())), name


@pytest.mark.parametrize(
    "operator",
    [classify.product_revenue, revenue.product_revenue_pareto, revenue.category_revenue_ranked, revenue.loss_making_products,
     inventory.daily_demand_stats],
)
def test_the_product_table_does_not_pass_through_the_driver(spark, operator):
    s = star(spark, [line(1), line(2, product_id=2)])
    text = plan(operator(s))
    joined = [d for d in text.split("\n\n") if d.strip().split("\n")[0].find("SortMergeJoin") > 0 and "product_id" in d]
    assert joined
    sent = [d for d in text.split("\n\n") if "BroadcastExchange" in d.split("\n")[0]]
    assert not any("category_name" in d or "product_name" in d for d in sent if "_slice" not in d and "total_revenue" not in d)


def test_lines_meet_their_customers_through_the_orders(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        text = plan(staged_lines(spark, SMALL, unique=True).select("market", "product_price", F.col("l_quantity")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [d for d in text.split("\n\n") if "Exchange" in d.split("\n")[0] and "hashpartitioning(o_custkey" in d]
    assert len(dealt) == 1 and "l_partkey" not in dealt[0]
    copies = next(d for d in text.split("\n\n") if "Exchange" in d.split("\n")[0] and "hashpartitioning(order_item_id" in d)
    assert "_source_position" not in copies
