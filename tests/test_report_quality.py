from __future__ import annotations

import pytest

from tests.frames import by, line, rows, star
from tidelane.operators import delivery, quality, report


def _routes(spark):
    return delivery.otif_by_route(star(spark, [
        line(1, market="A", shipping_mode="S", days_real=2), line(2, market="A", shipping_mode="S", days_real=3, sales_amount=40),
        line(3, market="A", shipping_mode="T", days_real=1), line(4, market="B", shipping_mode="S", days_real=2),
        line(5, market="B", shipping_mode="S", days_real=2),
    ]))


def test_missing_route_is_zero_in_a_heatmap(spark):
    got = rows(report.heatmap_otif(_routes(spark), report.shipping_modes(_routes(spark))))
    assert got == [{"market": "A", "S": 50.0, "T": 100.0}, {"market": "B", "S": 100.0, "T": 0.0}]
    known = rows(report.heatmap_delay(_routes(spark), ["S", "T"]))
    assert [r["market"] for r in known] == ["A", "B"] and known[0]["T"] == -1.0


def test_bands(spark):
    got = by(report.heatmap_bands(_routes(spark), ["S", "T"]), "metric", "market", "shipping_mode")
    assert len(got) == 12
    assert got[("otif_rate_pct", "A", "S")]["band"] == "warning" and got[("otif_rate_pct", "B", "T")]["band"] == "danger"
    assert got[("avg_delay_days", "A", "S")]["band"] == "none"


def test_route_total_is_a_mean_of_means(spark):
    got = rows(report.route_scorecard(_routes(spark)))
    assert [r["is_total"] for r in got] == [0, 0, 0, 1]
    assert got[0]["market"] == "A" and got[0]["low_otif"] is True
    total = got[3]
    assert total["total_orders"] == 5 and total["otif_rate"] == 0.8
    assert total["avg_real_days"] == pytest.approx((2.5 + 1 + 2) / 3)


def test_month_total(spark):
    s = star(spark, [line(1, sales_amount=0, profit_per_order=1)])
    got = rows(report.monthly_report(delivery.monthly_delivery_trends(s)))
    assert got[0]["profit_margin"] == 0.0 and got[1]["profit_margin"] is None and got[1]["total_orders"] == 1


def test_cards(spark):
    s = star(spark, [line(1), line(2, days_real=5, sales_amount=30)])
    az = spark.createDataFrame([(3,)], "az_sku_count long")
    got = by(report.kpi_cards(delivery.overall_kpis(s), az), "kpi")
    assert len(got) == 6
    assert (got["OVERALL OTIF RATE"]["value"], got["OVERALL OTIF RATE"]["sub_value"], got["OVERALL OTIF RATE"]["band"]) == (50.0, 95.0, "amber")
    assert got["LATE REVENUE AT RISK"]["sub_value"] == 75.0 and got["CRITICAL 'AZ' SKUs"]["value"] == 3.0


def _faulty(spark):
    return star(spark, [
        line(1), line(1, sales_amount=None), line(2, product_id=9, quantity_ordered=0), line(3, customer_id=8, days_real=-1),
        line(4, discount_rate=1.5, market=None), line(5, product_price=0, days_scheduled=0, late_delivery_risk=3),
    ], products=[1], customers=[1])


def test_audits(spark):
    s = _faulty(spark)
    assert rows(quality.dq_null_audit(s.fact))[0]["null_sales"] == 1
    assert rows(quality.dq_duplicate_keys(s.fact)) == [{"order_item_id": 1, "occurrence_count": 2}]
    ranges = rows(quality.dq_range_audit(s.fact))[0]
    assert [v for k, v in ranges.items() if k != "audit_type"] == [1, 1, 1, 1, 1, 0]
    assert rows(quality.dq_orphan_products(s.fact, s.products))[0]["orphan_count"] == 1
    assert rows(quality.dq_orphan_customers(s.fact, s.customers))[0]["orphan_count"] == 1
    card = by(quality.dq_scorecard(s), "check_name", "metric")
    assert card[("Null Fact Check", "records")]["value"] == 6 and card[("Orphan Products", "orphans")]["value"] == 1


def test_constraints_and_quarantine(spark):
    s = _faulty(spark)
    got = {k: v["violations"] for k, v in by(quality.dq_constraints(s), "table_name", "rule", "column_name").items()}
    assert {k for k, v in got.items() if v} == {
        ("fact_orders", "not_null", "sales_amount"), ("fact_orders", "not_null", "market"),
        ("fact_orders", "check", "quantity_ordered"), ("fact_orders", "check", "late_delivery_risk"),
        ("fact_orders", "primary_key", "order_item_id"), ("fact_orders", "foreign_key", "product_id"),
        ("fact_orders", "foreign_key", "customer_id"),
    }
    bad, good = quality.quarantine_lines(s.fact).count(), quality.passing_lines(s.fact).count()
    assert (bad, good) == (4, 2)
