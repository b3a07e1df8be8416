from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tests.frames import by, line, rows, star
from tidelane.operators import classify, revenue


def _revenue(spark, values):
    return spark.createDataFrame([(i + 1, Decimal(str(v))) for i, v in enumerate(values)], "product_id long, total_revenue decimal(26,2)")


def _weekly(spark, series):
    return spark.createDataFrame(
        [(p, f"2024-{w:02d}", q) for p, qs in series.items() for w, q in enumerate(qs)],
        "product_id long, order_year_week string, weekly_quantity long",
    )


def _sold(spark, values):
    return star(spark, [line(i + 1, product_id=i + 1, sales_amount=v) for i, v in enumerate(values)])


def _classes(df, column):
    return "".join(r[column] for r in sorted(rows(df), key=lambda r: r["product_id"]))


def test_the_product_that_crosses_a_bound(spark):
    assert _classes(classify.abc_classify(_revenue(spark, [79, 11, 10])), "abc_class") == "AAB"
    assert _classes(revenue.product_revenue_pareto(_sold(spark, [79, 11, 10])), "sql_abc_class") == "ABC"
    assert _classes(classify.abc_classify(_revenue(spark, [80, 15, 5])), "abc_class") == "ABC"
    assert _classes(revenue.product_revenue_pareto(_sold(spark, [80, 15, 5])), "sql_abc_class") == "ABC"


def test_tied_revenue(spark):
    got = by(classify.abc_classify(_revenue(spark, [50, 25, 25])), "product_id")
    assert [got[i]["cumulative_revenue_pct"] for i in (1, 2, 3)] == [50.0, 75.0, 100.0]
    shared = by(revenue.product_revenue_pareto(_sold(spark, [50, 25, 25])), "product_id")
    assert [shared[i]["cumulative_revenue_pct"] for i in (1, 2, 3)] == [50.0, 100.0, 100.0]


def test_no_revenue_at_all(spark):
    got = rows(classify.abc_classify(_revenue(spark, [0, 0, 0])))
    assert {(r["abc_class"], r["revenue_share_pct"], r["cumulative_revenue_pct"]) for r in got} == {("C", 0.0, 0.0)}


def test_variability_classes(spark):
    got = by(classify.xyz_classify(_weekly(spark, {
        1: [5, 5, 5], 2: [1, 1, 2, 3, 3], 3: [1, 2, 3, 3, 11], 4: [1, 1, 1, 1, 50], 5: [4, 4, 4, 4], 6: [7],
    })), "product_id")
    assert {p: (r["demand_cv"], r["xyz_class"]) for p, r in got.items() if p != 4} == {
        1: (9.99, "Z"), 2: (0.5, "X"), 3: (1.0, "Y"), 5: (0.0, "X"), 6: (9.99, "Z"),
    }
    assert got[4]["xyz_class"] == "Z" and got[4]["demand_cv"] == pytest.approx((480.2 ** 0.5) / 10.8)
    assert got[6]["std_demand"] == 0.0


def _classified(spark):
    abc = classify.abc_classify(_revenue(spark, [79, 11, 10]))
    return classify.segment_strategy(classify.abc_xyz(abc, classify.xyz_classify(_weekly(spark, {1: [5, 5, 5, 5]}))))


def test_products_without_history_and_strategy(spark):
    got = by(_classified(spark), "product_id")
    assert {p: r["abc_xyz_segment"] for p, r in got.items()} == {1: "AX", 2: "AZ", 3: "BZ"}
    assert got[2]["operational_priority"] == "CRITICAL RISK" and got[2]["demand_cv"] == 9.99 and got[2]["observations"] == 0
    assert rows(classify.az_sku_count(_classified(spark))) == [{"az_sku_count": 1}]


def test_unknown_segment(spark):
    df = spark.createDataFrame([("QQ",)], "abc_xyz_segment string")
    assert rows(classify.segment_strategy(df))[0]["risk_level"] == "N/A"


def test_grid_keeps_empty_cells(spark):
    got = rows(classify.nine_box_grid(_classified(spark)))
    assert [r["abc_class"] + r["xyz_class"] for r in got] == ["AX", "AY", "AZ", "BX", "BY", "BZ", "CX", "CY", "CZ"]
    assert sum(r["sku_count"] for r in got) == 3 and got[1]["total_revenue"] == 0
    assert got[2]["cell_text"] == "1 SKUs | AZ: CRITICAL RISK BUFFER"


def test_loss_audit_and_weeks(spark):
    day = datetime(2023, 1, 1)
    s = star(spark, [
        line(1, product_id=1, profit_per_order=-1), line(2, product_id=1, profit_per_order=5),
        line(3, product_id=2, profit_per_order=-9), *[line(10 + i, product_id=2, profit_per_order=0.1) for i in range(9)],
        *[line(30 + i, product_id=3, profit_per_order=-1 if i == 0 else 5, order_date=day + timedelta(days=i)) for i in range(4)],
    ])
    assert sorted(by(revenue.loss_making_products(s), "product_id")) == [1, 2]
    weeks = {r["order_year_week"]: r["weekly_quantity"] for r in rows(classify.weekly_quantity(s)) if r["product_id"] == 3}
    assert weeks == {"2023-00": 1, "2023-01": 3}


def test_one_product_with_most_lines(spark):
    many = [line(i, product_id=1 if i % 3 else i, sales_amount=i, order_date=datetime(2024, 1, 1) + timedelta(days=i % 90)) for i in range(1, 600)]
    s = star(spark, many)
    got = by(classify.product_revenue(s), "product_id")
    assert float(got[1]["total_revenue"]) == sum(i for i in range(1, 600) if i % 3)
    assert got[1]["total_orders"] == sum(1 for i in range(1, 600) if i % 3)
    shares = rows(classify.abc_classify(classify.product_revenue(s)))
    assert sum(r["revenue_share_pct"] for r in shares) == pytest.approx(100.0)


def test_labels_of_all_segments_and_totals():
    """Stated here on their own, so a changed label is noticed."""
    from tidelane import params

    short = {row[0]: (row[1], row[2], row[3]) for row in params.SEGMENT_STRATEGY}
    assert short == {
        "AX": ("HIGH", "LOW", "Automate Replenishment (JIT)"),
        "AY": ("HIGH", "MEDIUM", "Close Monitoring & Seasonal Buffer"),
        "AZ": ("CRITICAL RISK", "HIGH", "Active Management / Make-to-Order"),
        "BX": ("MEDIUM", "LOW", "Standard Periodic Replenishment"),
        "BY": ("MEDIUM", "MEDIUM", "Periodic S&OP Review"),
        "BZ": ("MEDIUM-HIGH RISK", "HIGH", "Inventory Rationalization"),
        "CX": ("LOW", "LOW", "Bulk Order / High MOQ"),
        "CY": ("LOW", "LOW-MEDIUM", "Standard Reorder Tolerances"),
        "CZ": ("PURGE / MONITOR", "HIGH (OBSOLESCENCE)", "Obsolescence Review / Rationalize"),
    }
    assert [row[5] for row in params.SEGMENT_STRATEGY] == [
        "AX: JIT Replenish", "AY: Seasonal Buffer", "AZ: CRITICAL RISK BUFFER", "BX: Automated Reorder", "BY: Periodic Review",
        "BZ: Rationalize MOQ", "CX: Bulk Order", "CY: Standard Tol.", "CZ: PURGE CANDIDATE",
    ]
    assert (params.ROUTE_TOTAL, params.MONTH_TOTAL, params.ROSTER_TOTAL) == (
        "TOTAL / ENTERPRISE AVERAGE", "FULL PERIOD TOTAL / AVG", "TOTAL PORTFOLIO ALLOCATION"
    )
    assert (params.REORDER, params.OVERSTOCKED, params.OPTIMAL) == ("REORDER IMMEDIATELY", "OVERSTOCKED", "OPTIMAL")


def test_abc_runs_no_job_by_itself_and_breaks_ties_by_number(spark):
    values = [5, 0, 7, 5, 0, 7, 7, 0, 1, 5]
    given = _revenue(spark, values)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("abc", "abc")
    try:
        got = classify.abc_classify(given)
        assert list(tracker.getJobIdsForGroup("abc")) == []
        reached = {r["product_id"]: r["cumulative_revenue_pct"] for r in rows(got)}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    numbers = sorted(reached)
    order = sorted(zip(numbers, values), key=lambda x: (-x[1], x[0]))
    total, upto = sum(values), 0
    for number, value in order:
        upto += value
        assert reached[number] == pytest.approx(100 * upto / total)
