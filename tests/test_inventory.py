from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tests.frames import by, line, rows, star
from tidelane.operators import inventory, report


def _stock(spark, values):
    return spark.createDataFrame(
        [(i + 1, rop, stock, Decimal(10)) for i, (rop, stock) in enumerate(values)],
        "product_id long, reorder_point_units long, current_stock_units long, product_price decimal(18,4)",
    )


def test_status_bounds(spark):
    got = by(inventory.stock_status(_stock(spark, [(10, 10), (10, 22), (10, 23), (10, 9)])), "product_id")
    assert [got[i]["stock_status"] for i in (1, 2, 3, 4)] == ["OPTIMAL", "OPTIMAL", "OVERSTOCKED", "REORDER IMMEDIATELY"]


def test_excess_counts_inside_optimal_and_excludes_shortage(spark):
    df = inventory.stockout_risk(inventory.excess_capital(inventory.inventory_valuation(inventory.stock_status(_stock(spark, [(10, 21), (10, 4)])))))
    got = by(df, "product_id")
    assert (got[1]["stock_status"], got[1]["excess_stock_units"], got[1]["stockout_shortage_units"]) == ("OPTIMAL", 1, 0)
    assert (got[2]["excess_stock_units"], got[2]["stockout_shortage_units"], got[2]["stockout_revenue_at_risk"]) == (0, 6, 60)
    assert (got[1]["inventory_valuation"], got[1]["annual_holding_cost"]) == (210, 42)


def test_one_day_constant_lead_time_and_formula(spark):
    s = star(spark, [line(1, product_id=1, quantity_ordered=4, days_real=3), line(2, product_id=1, quantity_ordered=1, days_real=3)])
    stats = rows(inventory.daily_demand_stats(s))[0]
    assert (stats["total_units"], stats["active_days"], stats["mean_daily_demand"], stats["std_daily_demand"]) == (5, 1, 5.0, 0.0)
    route = rows(inventory.route_lead_time(s))[0]
    assert (route["avg_lead_time_days"], route["lead_time_variance"], route["std_lead_time_days"]) == (3.0, 0.0, 0.5)
    got = rows(inventory.reorder_levels(s))[0]
    # 1.65 * sqrt(25 * 0.25) = 4.125; 5 * 3 = 15
    assert (got["safety_stock_units"], got["lead_time_demand_units"], got["reorder_point_units"]) == (5, 15, 20)


def test_unknown_route_falls_back(spark):
    stats = spark.createDataFrame([(1, "cat")], "product_id long, category_name string")
    primary = spark.createDataFrame([], "product_id long, primary_shipping_mode string, primary_market string")
    routes = spark.createDataFrame([], "category_name string, shipping_mode string, market string, avg_lead_time_days double, std_lead_time_days double")
    got = rows(inventory.product_lead_time(stats, primary, routes))[0]
    assert (got["avg_lead_time_days"], got["std_lead_time_days"]) == (4.0, 1.0)


def test_primary_route_ties(spark):
    s = star(spark, [line(1, shipping_mode="B", market="M"), line(2, shipping_mode="A", market="Z"), line(3, shipping_mode="A", market="Y")])
    got = rows(inventory.primary_route(s))
    assert got == [{"product_id": 1, "primary_shipping_mode": "A", "primary_market": "Y"}]


def test_snapshot_takes_precedence_and_stand_in_is_stable(spark):
    levels = spark.createDataFrame([(1, 100), (2, 100), (99999999999, 0)], "product_id long, reorder_point_units long")
    snapshot = spark.createDataFrame([(2, 3), (2, 4)], "product_id long, current_stock_units long")
    got = by(inventory.on_hand_stock(levels, snapshot), "product_id")
    again = by(inventory.on_hand_stock(levels.repartition(3)), "product_id")
    assert (got[2]["current_stock_units"], got[2]["stock_source"]) == (7, "counted")
    assert got[1]["stock_source"] == "stand-in"
    assert got[1]["current_stock_units"] == again[1]["current_stock_units"] and 40 <= got[1]["current_stock_units"] <= 250
    assert got[99999999999]["current_stock_units"] == 1


def test_master_with_and_without_rollups(spark):
    from tidelane.operators.classify import classify_products
    from tidelane.star import daily_rollup, route_rollup

    lines = [
        line(i, product_id=i % 7, quantity_ordered=i % 5 + 1, days_real=i % 4, shipping_mode="AB"[i % 2],
             order_date=datetime(2024, 1 + i % 12, 1 + i % 28, i % 24), sales_amount=i % 11)
        for i in range(200)
    ]
    s = star(spark, lines)
    rolled = s.with_rollups(daily_rollup(s.fact), route_rollup(s.fact))
    a = by(inventory.inventory_master(s, classify_products(s)), "product_id")
    b = by(inventory.inventory_master(rolled, classify_products(rolled)), "product_id")
    assert a == b and len(a) == 7
    for r in a.values():
        assert r["reorder_point_units"] >= r["safety_stock_units"]
        assert r["excess_stock_units"] == 0 or r["stockout_shortage_units"] == 0
    assert "abc_class" not in inventory.inventory_master(s).columns


def test_lookup_directive_and_days(spark):
    master = spark.createDataFrame(
        [
            (1, "one", "cat", "dep", Decimal(5), "AX", 2.5, 3.0, 1, 10, 4, "REORDER IMMEDIATELY", Decimal(20), Decimal(0), Decimal(30)),
            (2, "two", "cat", "dep", Decimal(5), "BX", 0.0, 3.0, 1, 10, 23, "OVERSTOCKED", Decimal(115), Decimal(15), Decimal(0)),
            (3, "three", "cat", "dep", Decimal(5), None, 4.0, 3.0, 1, 10, 10, "OPTIMAL", Decimal(50), Decimal(0), Decimal(0)),
        ],
        "product_id long, product_name string, category_name string, department_name string, product_price decimal(18,4), "
        "abc_xyz_segment string, mean_daily_demand double, avg_lead_time_days double, safety_stock_units long, "
        "reorder_point_units long, current_stock_units long, stock_status string, inventory_valuation decimal(26,2), "
        "excess_capital_tied_up decimal(26,2), stockout_revenue_at_risk decimal(26,2)",
    )
    asked = spark.createDataFrame([(1,), (77,), (3,)], "product_id long")
    got = by(report.sku_lookup(asked, master), "product_id")
    assert (got[77]["product_name"], got[77]["category_name"], got[77]["current_stock_units"]) == ("SKU Not Found", "N/A", 0)
    assert got[1]["product_name"] == "one" and got[3]["abc_xyz_segment"] == "N/A"
    texts = by(report.sku_directive(master), "product_id")
    assert "(6 units below" in texts[1]["operational_directive"]
    assert "OVERSTOCKED" in texts[2]["operational_directive"] and "OPTIMAL" in texts[3]["operational_directive"]
    days = by(report.days_on_hand(master), "product_id")
    assert (days[1]["days_on_hand"], days[2]["days_on_hand"], days[3]["days_on_hand"]) == (1.6, None, 2.5)
    roster = rows(report.reorder_roster(master))
    assert [r["product_id"] for r in roster] == [1, 2, 3, None]
    assert (roster[3]["current_stock_units"], float(roster[3]["inventory_valuation"])) == (37, 185.0)
