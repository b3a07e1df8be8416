"""Publication of loads, names that follow them, appended lines."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.frames import rows
from tidelane.operators import quality
from tidelane.operators.cleaning import settle_dates
from tidelane.plans import batch
from tidelane.plans.batch import append_star, build_results, run, stage_results, stage_star
from tidelane.plans.views import VIEWS, register_stored_views
from tidelane.sources import catalog, loads, store
from tidelane.sources.loads import RivalLoad, Tables, new_draft, publish, published
from tidelane.sources.raw_orders import read_raw_orders
from tidelane.sources.store import known_keys, read_keys, read_star, read_table, runtime_filters
from tidelane.sources.tpch import raw_lines
from tidelane.star import ROLLUPS

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
RESULTS = [operator.__name__ for operator in VIEWS.values()]


def write_csv(df, path):
    df.drop("_source_position").coalesce(1).write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(path)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Two folders of raw lines, the second with copies of lines and products of the first."""
    folder = str(tmp_path_factory.mktemp("raw"))
    raw = raw_lines(spark, SMALL)
    late = F.pmod(F.xxhash64("Order Item Id", "Product Price"), F.lit(10)) == 0
    write_csv(raw.where(~late), f"{folder}/a")
    write_csv(raw.where(late), f"{folder}/b")
    return f"{folder}/a", f"{folder}/b"


@pytest.fixture(scope="module")
def first(spark, files, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    run(spark, files[0], root)
    return root


def raw(spark, *paths):
    return read_raw_orders(spark, list(paths), position=True)


def table_rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_a_run_is_one_publication(spark, first):
    assert loads.load_numbers(spark, first) == [1]
    load = published(spark, first)
    assert {"fact_orders", "etl_audit", "dq_scorecard", "report_kpi_cards", *RESULTS} <= set(load.tables)
    assert len({folder.split("/")[1] for folders in load.tables.values() for folder in folders}) == 1


def test_readers_and_views_over_a_reload(spark, files, tmp_path, monkeypatch):
    """Between the steps of a run readers see the load before; after it readers and views see the new one."""
    root, seen = str(tmp_path), []
    run(spark, files[1], root)
    before = read_star(spark, root).fact.count()
    kpis = table_rows(read_table(spark, "report_kpi_cards", root=root))
    own = f"{catalog.database_of(root)}.fact_orders"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW mine AS SELECT count(*) AS n FROM {own}")
    views = {name: table_rows(spark.table(name)) for name in register_stored_views(spark, root)}

    def watched(spark, tables, *rest):
        for step in ("before", "after"):
            assert read_star(spark, root, rollups=True).fact.count() == before == spark.table("mine").first().n
            assert table_rows(read_table(spark, "report_kpi_cards", root=root)) == kpis
            seen.append(step)
            if step == "before":
                stage_results(spark, tables, *rest)

    monkeypatch.setattr(batch, "stage_results", watched)
    run(spark, files[0], root)
    assert seen == ["before", "after"]
    fact = read_star(spark, root).fact.count()
    assert fact > before and loads.load_numbers(spark, root) == [1, 2]
    assert read_star(spark, root, load=1).fact.count() == before
    assert table_rows(read_table(spark, "report_kpi_cards", root=root, load=1)) == kpis
    assert spark.table("mine").first().n == fact == spark.table(own).count()
    assert spark.table("v_otif_by_route").agg(F.sum("total_orders")).first()[0] == fact
    for name in VIEWS:
        now = table_rows(spark.table(name))
        assert now != views[name] and len(now) == read_table(spark, VIEWS[name].__name__, root=root).count()
    draft = new_draft(spark, root)  # a load without results: no view answers from the load before
    draft.write(read_star(spark, root, load=1).fact, "fact_orders")
    publish(draft)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.table("v_otif_by_route").collect()
    assert spark.table("mine").first().n == before


def test_a_failed_result_step_publishes_nothing(spark, files, tmp_path, monkeypatch):
    root = str(tmp_path)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch.report, "kpi_cards", broken)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, files[1], root)
    assert loads.load_numbers(spark, root) == []


def test_the_later_of_two_rival_loads_fails(spark, tmp_path):
    root = str(tmp_path)
    for number in (1, 2):
        rivals = [new_draft(spark, root) for _ in range(2)]
        for k, draft in enumerate(rivals):
            draft.write(spark.range(10 * number + k), "numbers")
        publish(rivals[1])
        with pytest.raises(RivalLoad):
            publish(rivals[0])
        assert read_table(spark, "numbers", root=root).count() == 10 * number + 1
    assert loads.load_numbers(spark, root) == [1, 2]
    assert not [n for n in os.listdir(f"{root}/loads") if "json-" in n and not n.endswith(".crc")]  # no hidden rest


def test_an_unfinished_table_is_not_published(spark, tmp_path):
    draft = new_draft(spark, str(tmp_path))
    draft.write(spark.range(3), "numbers")
    os.remove(f"{draft.path('numbers')}/_SUCCESS")
    with pytest.raises(ValueError, match="numbers"):
        publish(draft)
    assert published(spark, str(tmp_path)) is None


def test_results_of_a_root_with_loads_are_a_load(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    draft = new_draft(spark, root)
    draft.write(spark.range(3), "numbers")
    publish(draft)
    store.write_result(spark.range(5), root, "more")
    assert loads.load_numbers(spark, root) == [1, 2]
    assert read_table(spark, "more", root=root).count() == 5 and read_table(spark, "numbers", root=root).count() == 3
    with pytest.raises(ValueError, match="no table more"):
        read_table(spark, "more", root=root, load=1)
    assert Tables(spark, f"{root}/plain").has("x") is False


def test_old_loads_go(spark, tmp_path):
    root = str(tmp_path)
    for n in range(1, 5):
        draft = new_draft(spark, root, keep=True)
        draft.write(spark.range(n), "numbers")
        if n == 1:
            draft.write(spark.range(7), "kept")
        publish(draft)
    new_draft(spark, root).write(spark.range(1), "left")  # never published
    assert loads.remove_loads(spark, root, keep=2) == [1, 2]
    assert read_table(spark, "numbers", root=root).count() == 4 and read_table(spark, "numbers", root=root, load=3).count() == 3
    assert read_table(spark, "kept", root=root).count() == 7  # the first load's folder is still named
    assert len(os.listdir(f"{root}/versions")) == 3
    with pytest.raises(ValueError):
        loads.remove_loads(spark, root, keep=0)


@pytest.fixture(scope="module")
def appended(spark, files, first):
    """A draft that adds the second folder to the first load, and the stored tables that it read as lines."""
    read, scan, draft = [], Tables.read, new_draft(spark, first, keep=True)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Tables, "read", lambda self, name: read.append(name) or scan(self, name))
        append_star(raw(spark, files[1]), draft)
    stage_results(spark, draft)
    return draft, read


@pytest.fixture(scope="module")
def whole(spark, files, tmp_path_factory):
    # the stored lines come first: the second folder sorts after the first one
    root = str(tmp_path_factory.mktemp("whole"))
    run(spark, os.path.dirname(files[0]) + "/{a,b}", root)
    return published(spark, root)


def test_appending_gives_what_a_whole_load_gives(spark, appended, whole):
    draft, _ = appended
    one, other = read_star(spark, draft, rollups=True), read_star(spark, whole, rollups=True)
    for a, b in ((one.fact, other.fact), (one.products, other.products), (one.customers, other.customers)):
        assert table_rows(a) == table_rows(b)
    for name in ROLLUPS:
        assert table_rows(store.read_rollup(spark, draft, name)) == table_rows(store.read_rollup(spark, whole, name))
    assert table_rows(read_keys(spark, draft)) == table_rows(read_keys(spark, whole))
    own = {"typed_lines", "staged_lines", "rejected_lines", "fact_orders", "line_keys", "rollups", "dim_products", "dim_customers", "dq_raw_counts"}
    names = set(whole.tables)
    assert names == set(draft.tables)
    for name in names - own:
        assert table_rows(draft.read(name)) == table_rows(whole.read(name)), name
    for name in ("staged_lines", "rejected_lines"):
        a, b = (t.read(name).drop("_source_position") for t in (draft, whole))
        assert table_rows(a) == table_rows(b)


def test_appending_reads_keys_only_and_filters_them(spark, first, appended, capsys):
    draft, read = appended
    assert not {"fact_orders", "typed_lines", "staged_lines"} & set(read)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for keys beyond the threshold
    try:
        with runtime_filters(spark):
            known_keys(draft.newest("typed_lines"), read_keys(spark, first)).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    stored = next(part for part in plan.split("\n\n") if "Bucketed: true" in part)
    assert "GreaterThanOrEqual(order_item_id" in stored and "LessThanOrEqual(order_item_id" in stored
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold") != "0B"


def test_nothing_to_append_to(spark, files, tmp_path):
    with pytest.raises(ValueError, match="no load"):
        append_star(raw(spark, files[1]), new_draft(spark, str(tmp_path), keep=True))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_uniqueness_of_keys_needs_no_shuffle_of_them(spark, first):
    star = read_star(spark, first, rollups=True)
    keys = plan_of(quality.dq_duplicate_keys(star.fact, star.keys))
    assert "Exchange" not in keys and "bucketed" in keys.lower()
    part = quality._repeated_keys(star.fact, "fact_orders", "order_item_id", star.keys)
    assert "hashpartitioning" not in plan_of(part)
    lines = read_star(spark, first)
    assert table_rows(quality.dq_constraints(star)) == table_rows(quality.dq_constraints(lines))
    assert table_rows(quality.dq_duplicate_keys(star.fact, star.keys)) == table_rows(quality.dq_duplicate_keys(lines.fact)) == []
    fake = star.keys.where("copies > 0").select("order_item_id", F.lit(2).cast("long").alias("copies"))
    assert quality.dq_duplicate_keys(star.fact, fake).count() == star.fact.count()


def test_a_load_reads_typed_lines_and_fact_once_for_counts(spark, files, tmp_path, monkeypatch):
    plans = {}
    write = Tables.write

    def watched(self, df, name, *rest, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        write(self, df, name, *rest, **options)

    monkeypatch.setattr(Tables, "write", watched)
    draft = new_draft(spark, str(tmp_path))
    stage_star(raw(spark, files[1]), draft)
    lines = lambda name: len(re.findall(r"Relation \[[^\]]*quantity_ordered", plans[name]))
    assert lines("rollups") == lines("dq_raw_counts") == 1
    assert "Expand" in plans["rollups"] and "Expand" in plans["dq_raw_counts"]
    for name in ("dq_raw_line_audit", "dq_raw_duplicate_keys", "dq_raw_status_concordance", "dq_date_layouts"):
        assert lines(name) == 0 or "quantity_ordered#" not in plans[name].split("Relation")[0]
    typed = settle_dates(draft.read("typed_lines"), draft.read("dq_date_layouts"))
    flagged = batch.normalize_risk_flag(typed)
    assert table_rows(draft.read("dq_raw_line_audit")) == table_rows(quality.line_audit(typed))
    assert table_rows(draft.read("dq_raw_duplicate_keys")) == table_rows(quality.dq_duplicate_keys(typed))
    assert table_rows(draft.read("dq_raw_status_concordance")) == table_rows(quality.dq_status_concordance(flagged))


def test_results_of_a_plain_folder_stay_in_place(spark, first, tmp_path):
    folder = Tables(spark, str(tmp_path))
    star = read_star(spark, first)
    store.write_star(star, folder)
    store.write_rollups(spark, str(tmp_path))
    store.write_keys(spark, str(tmp_path), buckets=3)
    build_results(spark, str(tmp_path))
    assert published(spark, str(tmp_path)) is None
    assert table_rows(read_table(spark, "dq_scorecard", root=str(tmp_path))) == table_rows(read_table(spark, "dq_scorecard", root=first))
    assert rows(read_table(spark, "dq_constraints", root=str(tmp_path)).where("violations > 0")) == []
