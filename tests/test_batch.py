"""The whole run from raw text lines, on the smallest tables."""

from __future__ import annotations

import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.frames import by, rows
from tidelane.operators import classify, delivery, quality, report
from tidelane.plans import batch
from tidelane.plans.batch import build_results, load_star
from tidelane.plans.lookup import lookup_skus
from tidelane.plans.views import register_stored_views, register_views
from tidelane.sources.raw_orders import read_raw_orders
from tidelane.sources.loads import Tables, published
from tidelane.sources.store import read_rows, read_star, read_table, write_sorted, write_star
from tidelane.sources.tpch import raw_lines

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("store"))
    csv = f"{folder}/raw"
    raw_lines(spark, SMALL).drop("_source_position").coalesce(1).write.option("header", True).option(
        "escape", '"'
    ).option("encoding", "ISO-8859-1").csv(csv)
    load_star(read_raw_orders(spark, csv, position=True), folder)
    build_results(spark, folder)
    return folder


def test_audit_row_and_rejects_add_up(spark, root):
    audit = rows(read_table(spark, "etl_audit", root=root))[0]
    rejected = read_table(spark, "rejected_lines", root=root).count()
    staged = read_table(spark, "staged_lines", root=root)
    assert audit["initial_rows"] == 6000
    assert audit["rejected_rows"] == rejected
    assert audit["cleaned_rows"] + rejected == staged.count() == staged.select("order_item_id").distinct().count()
    assert audit["dropped_columns"] == 8


def test_star_passes_every_constraint(spark, root):
    broken = quality.dq_constraints(read_star(spark, root)).where("violations > 0")
    assert rows(broken) == []


def test_result_tables(spark, root):
    classified = read_table(spark, "inventory_abc_xyz_analysis", root=root)
    master = read_table(spark, "inventory_safety_stock_rop", root=root)
    assert classified.count() == master.count() > 0
    assert rows(master.where("reorder_point_units < safety_stock_units")) == []
    assert rows(master.where("excess_stock_units > 0 and stockout_shortage_units > 0")) == []
    lowest = {r["abc_class"]: r["low"] for r in rows(classified.groupBy("abc_class").agg(F.min("total_revenue").alias("low")))}
    highest = {r["abc_class"]: r["high"] for r in rows(classified.groupBy("abc_class").agg(F.max("total_revenue").alias("high")))}
    assert lowest["A"] >= highest["B"] and lowest["B"] >= highest["C"]
    grid = read_table(spark, "report_nine_box_grid", root=root)
    assert grid.agg(F.sum("sku_count")).first()[0] == classified.count()
    for name in ("kpi_cards", "route_scorecard", "profit_erosion_report", "monthly_report", "heatmap_bands",
                 "classification_roster", "reorder_roster", "sku_directive", "days_on_hand"):
        assert read_table(spark, f"report_{name}", root=root).count() > 0
    # audits of what came in see the faults that cleaning takes away
    assert rows(read_table(spark, "dq_raw_line_audit", root=root))[0]["non_positive_quantities"] > 0
    assert read_table(spark, "dq_raw_duplicate_keys", root=root).count() > 0
    assert read_table(spark, "dq_raw_status_concordance", root=root).count() > 3


def test_rollups_give_what_the_lines_give(spark, root):
    lines, rolled = read_star(spark, root), read_star(spark, root, rollups=True)
    assert by(classify.product_revenue(lines), "product_id") == by(classify.product_revenue(rolled), "product_id")
    for operator, key in (
        (delivery.otif_by_route, ("market", "shipping_mode")), (delivery.monthly_delivery_trends, ("order_year_month",)),
        (delivery.segment_fulfillment, ("customer_segment",)), (delivery.late_cost_impact, ("market",)),
        (delivery.lead_time_distribution, ("market", "shipping_mode")), (delivery.overall_kpis, ("total_orders",)),
        (quality.dq_scorecard, ("check_name", "metric")),
    ):
        assert by(operator(lines), *key) == by(operator(rolled), *key)
    assert by(classify.weekly_quantity(lines), "product_id", "order_year_week") == by(
        classify.weekly_quantity(rolled), "product_id", "order_year_week"
    )


def test_results_read_the_fact_once(spark, root, monkeypatch):
    """For all counts; keys are read from their own table."""
    scans = []

    def counted(self, df, *_, **__):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        scans.append(len(re.findall(r"Relation \[order_item_id#\d+L?,order_id", plan)))

    monkeypatch.setattr(Tables, "write", counted)
    load = published(spark, root)
    monkeypatch.setattr(load, "write", counted.__get__(load))
    build_results(spark, load)
    assert sum(scans) == 1 and len(scans) > 20


def rows_read(df) -> int:
    """Rows that the scans of a query gave."""
    df.collect()
    found = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [found.apply(i).metrics() for i in range(found.size())]
    return sum(m.apply("numOutputRows").value() for m in metrics if m.contains("numOutputRows"))


def test_lookups_skip_row_groups(spark, tmp_path):
    numbers = spark.range(200_000).select((F.col("id") * 2).alias("product_id"), F.sha2(F.col("id").cast("string"), 256).alias("filler"))
    write_sorted(numbers, str(tmp_path), "sorted", "product_id", block="64k")
    wanted = spark.createDataFrame([(10,), (11,), (399_998,), (None,)], "product_id long")
    few = read_rows(spark, str(tmp_path), "sorted", "product_id", wanted)
    assert sorted(r.product_id for r in few.collect()) == [10, 399_998]
    assert 0 < rows_read(few) < 20_000
    absent = read_rows(spark, str(tmp_path), "sorted", "product_id", wanted.where("product_id = 11"))
    assert rows_read(absent) == 0  # inside the range of a row group, but not in its Bloom filter
    many = read_rows(spark, str(tmp_path), "sorted", "product_id", spark.range(1, 3000).withColumnRenamed("id", "product_id"))
    assert many.count() == 200_000


def test_lookup_of_stored_products(spark, root):
    master = read_table(spark, "inventory_safety_stock_rop", root=root)
    requested = master.select("product_id").limit(5).union(spark.createDataFrame([(-7,)], "product_id long"))
    requested = spark.createDataFrame(requested.collect(), "product_id long")
    assert by(lookup_skus(spark, root, requested), "product_id") == by(report.sku_lookup(requested, master), "product_id")


def test_months_are_pruned(spark, root):
    months = [r["order_year_month"] for r in rows(delivery.monthly_delivery_trends(read_star(spark, root, since="1996-03", until="1996-05")))]
    assert months == ["1996-03", "1996-04", "1996-05"]
    with pytest.raises(ValueError):
        read_star(spark, root, rollups=True, since="1996-03")


def test_views_answer_sql(spark, root):
    names = register_views(spark, read_star(spark, root))
    assert len(names) == 9
    got = spark.sql("SELECT market, sum(total_orders) AS n FROM v_otif_by_route GROUP BY market")
    assert sum(r["n"] for r in rows(got)) == read_star(spark, root).fact.count()
    assert read_table(spark, "v_late_delivery_cost_impact", ["market"]).columns == ["market"]


def test_a_later_session_finds_the_views(spark, root):
    names = register_stored_views(spark, root)
    assert len(names) == 9 and all(spark.table(name).count() > 0 for name in names)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_writing_again_replaces_all_months(spark, root, tmp_path, mode):
    star = read_star(spark, root)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        write_star(star, str(tmp_path))
        few = star.fact.where("order_date < '1996-01-01'")
        write_star(replace(star, fact=few), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert read_star(spark, str(tmp_path)).fact.count() == few.count() < star.fact.count()


def test_a_failed_load_leaves_the_one_before(spark, root, monkeypatch):
    before = read_star(spark, root).fact.count()

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, "write_rollups", broken)
    few = read_raw_orders(spark, f"{root}/raw", position=True).limit(10)
    with pytest.raises(RuntimeError):
        load_star(few, root)
    assert read_star(spark, root).fact.count() == before
    assert read_table(spark, "etl_audit", root=root).first()["initial_rows"] == 6000


def test_a_second_load_replaces_the_first(spark, root):
    load_star(read_raw_orders(spark, f"{root}/raw", position=True).where("`Order Item Id` < 1000"), root)
    star = read_star(spark, root)
    assert 0 < star.fact.count() < 1000 and star.fact.where("order_item_id >= 1000").count() == 0
