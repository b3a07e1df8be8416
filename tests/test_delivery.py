from __future__ import annotations

from datetime import datetime

from tests.frames import by, line, rows, star
from tidelane.operators import delivery


def _sample(spark):
    return star(spark, [
        line(1, market="A", days_real=2, sales_amount=100, profit_per_order=10, customer_id=1),
        line(2, market="A", days_real=3, sales_amount=50, profit_per_order=-5, customer_id=1),
        line(3, market="A", days_real=1, sales_amount=10.005, profit_per_order=1, customer_id=2),
        line(4, market="B", days_real=9, sales_amount=20, profit_per_order=2, customer_id=2, order_date=datetime(2024, 2, 29, 23, 59)),
        line(5, market="C", days_real=2, sales_amount=0, profit_per_order=1, customer_id=3),
        line(6, market="C", days_real=4, sales_amount=5, profit_per_order=1, customer_id=3),
    ])


def test_routes(spark):
    got = by(delivery.otif_by_route(_sample(spark)), "market")
    a = got["A"]
    assert (a["total_orders"], a["on_time_orders"], a["late_orders"]) == (3, 2, 1)
    assert (a["otif_rate_pct"], a["late_rate_pct"], a["avg_delay_days"]) == (66.67, 33.33, 0.0)
    assert float(a["total_route_sales"]) == 160.01 and float(a["late_revenue_at_risk"]) == 50.0
    for r in got.values():
        assert r["on_time_orders"] + r["late_orders"] == r["total_orders"]


def test_months(spark):
    got = rows(delivery.monthly_delivery_trends(_sample(spark)))
    assert [r["order_year_month"] for r in got] == ["2024-01", "2024-02"]
    assert got[1]["monthly_otif_pct"] == 0.0 and got[1]["avg_delay_days"] == 7.0


def test_segments_rank_by_shown_rate(spark):
    got = by(delivery.segment_fulfillment(_sample(spark)), "customer_segment")
    assert {k: v["worst_fulfillment_rank"] for k, v in got.items()} == {"segment 0": 1, "segment 1": 1, "segment 2": 1}
    assert got["segment 1"]["otif_rate_pct"] == 50.0


def test_market_with_one_kind_is_left_out_and_zero_sales_give_no_margin(spark):
    got = by(delivery.late_cost_impact(_sample(spark)), "market")
    assert sorted(got) == ["A", "C"]
    assert got["C"]["on_time_margin_pct"] is None and got["C"]["margin_compression_pct"] is None
    assert float(got["A"]["profit_erosion_per_order"]) == 10.5


def test_lead_times(spark):
    got = by(delivery.lead_time_distribution(_sample(spark)), "market")
    assert (got["A"]["min_lead_time_days"], got["A"]["max_lead_time_days"], got["A"]["lead_time_variance"]) == (1, 3, 0.667)
    assert got["B"]["lead_time_variance"] == 0.0


def test_overall(spark):
    got = rows(delivery.overall_kpis(_sample(spark)))[0]
    assert (got["total_orders"], got["on_time_orders"], got["late_orders"], got["otif_pct"]) == (6, 3, 3, 50.0)
