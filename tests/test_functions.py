from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.frames import by, rows
from tidelane.functions import dates, lineage, numeric
from tidelane.functions.running import ladder, running_sums


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (-2.5,), (2.5,)], "x double")
    got = [(r["a"], r["b"]) for r in df.select(numeric.rnd(F.col("x"), 2).alias("a"), numeric.rnd(F.col("x"), 0).alias("b")).collect()]
    assert got == [(1.01, 1.0), (0.29, 0.0), (-2.5, -3.0), (2.5, 3.0)]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    got = [tuple(r) for r in df.select(numeric.ratio(F.col("a"), F.col("b")), numeric.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [(None, None), (0.25, 25.0)]


def test_deviation_from_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 3), ("a", 3), ("b", 7), ("c", 10**10), ("c", 3 * 10**10)], "k string, x long")
    x = F.col("x")
    sums = df.groupBy("k").agg(F.count(x).alias("n"), F.sum(x).alias("s"), F.sum(numeric.square(x)).alias("q"))
    got = by(sums.select("k", numeric.deviation(F.col("n"), F.col("s"), F.col("q"), True).alias("sd"),
                         numeric.variance(F.col("n"), F.col("s"), F.col("q")).alias("v")), "k")
    assert got["a"]["sd"] == pytest.approx(0.83666, abs=1e-5)
    assert got["a"]["v"] == pytest.approx(0.56)
    assert got["b"]["sd"] == 0.0
    assert got["c"]["sd"] == pytest.approx(1.4142135623e10)


def test_week_key_matches_strftime(spark):
    days = [date(2015, 1, 1) + timedelta(days=i) for i in range(0, 3700)] + [date(2023, 1, 1), date(2024, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for d, key, month in df.select("d", dates.year_week(F.col("d")), dates.month_key(dates.month_start(F.col("d")))).collect():
        assert key == d.strftime("%Y-%W")
        assert month == d.strftime("%Y-%m")


class _Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, named=None):
        self.folder = None
        self.sparkContext = SimpleNamespace(
            master=master, getCheckpointDir=lambda: self.folder, setCheckpointDir=self._set
        )
        self.conf = SimpleNamespace(get=lambda key, default: named or default)

    def _set(self, folder):
        self.folder = folder


def test_checkpoint_folder_named_by_the_session_is_used():
    cluster = _Session("spark://host:7077", "hdfs://shared/points")
    assert lineage.shared_folder(cluster) == "hdfs://shared/points" == cluster.folder
    assert lineage.shared_path(cluster, "x").startswith("hdfs://shared/points/tidelane/x-")


def test_no_folder_is_made_up_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.shared_folder(_Session("spark://host:7077"))
    assert lineage.shared_folder(_Session("local[2]"))


VALUES = [50] * 40 + [7, 3, 3, 99, 98, 97, 12, 12, 12, 0, 0, 1] + list(range(20, 60))


def _frame(spark):
    return spark.createDataFrame([(i, Decimal(v)) for i, v in enumerate(VALUES)], "id long, v decimal(10,2)").repartition(3)


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_running_sums_equal_a_plain_loop(spark, slices):
    df = _frame(spark)
    got = by(running_sums(df, {"run": "v"}, [F.col("v").desc(), F.col("id")], slices), "id")
    total, seen = sum(VALUES), 0
    for i, v in sorted(enumerate(VALUES), key=lambda p: (-p[1], p[0])):
        seen += v
        assert got[i]["run"] == seen
        assert got[i]["run_total"] == total
    assert len(got) == len(VALUES)


@pytest.mark.parametrize("descending", [True, False])
def test_ladder_gives_ties_one_total_and_one_rank(spark, descending):
    got = by(ladder(_frame(spark), "v", descending), "id")
    distinct = sorted(set(VALUES), reverse=descending)
    for i, v in enumerate(VALUES):
        reached = sum(x for x in VALUES if (x >= v if descending else x <= v))
        assert got[i]["cumulative"] == reached
        assert got[i]["dense_rank"] == distinct.index(v) + 1
        assert got[i]["grand_total"] == sum(VALUES)


def test_ladder_of_values_of_either_sign(spark):
    values = [Decimal(str(v)) for v in (-1000000, -3, -2.5, -0.01, 0, 0, 0.01, 0.02, 5, 5, 12345678.9)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v decimal(18,2)")
    got = by(ladder(df, "v", False), "id")
    for i, v in enumerate(values):
        assert got[i]["cumulative"] == sum(x for x in values if x <= v)
        assert got[i]["dense_rank"] == sorted(set(values)).index(v) + 1


def test_ladder_runs_no_job_before_it_is_read(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ladder", "building")
    ladder(_frame(spark), "v")
    assert len(tracker.getJobIdsForGroup("ladder")) == 0


def test_ladder_keeps_rows_without_a_value(spark):
    df = spark.createDataFrame([(1, Decimal(5)), (2, None)], "id long, v decimal(10,2)")
    got = by(ladder(df, "v"), "id")
    assert got[1]["cumulative"] == 5 and got[2]["v"] is None and len(got) == 2


def test_plain_turns_decimals_to_double(spark):
    df = spark.createDataFrame([(Decimal("1.50"), "x")], "a decimal(9,2), `b c` string")
    assert numeric.plain(df).dtypes == [("a", "double"), ("b c", "string")]
    assert rows(numeric.plain(df)) == [{"a": 1.5, "b c": "x"}]
