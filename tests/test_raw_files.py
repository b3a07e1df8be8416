"""Raw files with broken records: every record ends in the fact, in the rejects, or as a true copy."""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.frames import by, rows
from tidelane.operators import cleaning
from tidelane.plans.batch import load_star
from tidelane.schema import COLUMN_NAMES, MALFORMED
from tidelane.sources import raw_orders
from tidelane.sources.raw_orders import read_raw_orders
from tidelane.sources.store import read_table

HEADERS = [h for h in COLUMN_NAMES if h not in ("Order Date (DateOrders)", "Shipping Date (DateOrders)")]


def record(item, **given) -> list[str]:
    row = {
        "order_item_id": str(item), "order_id": "1", "order_customer_id": "5", "product_id": "77", "product_card_id": "77",
        "customer_id": "5", "category_id": "3", "category_name": "c", "department_id": "2", "department_name": "d",
        "order_date": "1/31/2018 22:56", "shipping_date": "2/3/2018 22:56", "quantity_ordered": "1", "days_real": "3",
        "days_scheduled": "4", "product_price": "10", "sales_amount": "10", "profit_per_order": "1", "discount_amount": "0",
        "discount_rate": "0", "late_delivery_risk": "0", "product_name": "p", "customer_segment": "s", "market": "m",
    }
    row.update({k: str(v) for k, v in given.items()})
    return [row.get(COLUMN_NAMES[h], "") for h in HEADERS]


def write(path, records: list[str]) -> str:
    path.write_text("\n".join([",".join(HEADERS), *records]) + "\n", encoding="latin-1")
    return str(path)


def line(item, **given) -> str:
    return ",".join(record(item, **given))


def loaded(spark, folder, file, multiline=False):
    load_star(read_raw_orders(spark, file, position=True, multiline=multiline), str(folder))
    read = lambda name: read_table(spark, name, root=str(folder))
    fact, rejected, audit = rows(read("fact_orders")), rows(read("rejected_lines")), rows(read("etl_audit"))[0]
    assert audit["cleaned_rows"] == len(fact) and audit["rejected_rows"] == len(rejected)
    return {r["order_item_id"]: r for r in fact}, rejected, audit


def test_large_amounts_and_ids_written_as_floats(spark, tmp_path):
    file = write(tmp_path / "a.csv", [
        line(1, sales_amount="123456789012.5", product_price="999999999999.99999999", order_item_total="10000000000.5"),
        line("2.0", customer_id="9007199254740993.0", category_id="12.0"),
        line(3, sales_amount="1e30"), line(4, sales_amount="much"), line(5, product_id="7.5"),
    ])
    fact, rejected, _ = loaded(spark, tmp_path / "out", file)
    assert fact[1]["sales_amount"] == Decimal("123456789012.5")
    assert fact[1]["product_price"] == Decimal("999999999999.99999999")
    assert fact[2]["customer_id"] == 9007199254740993  # no way through double
    reasons = {r["order_item_id"]: r["_reasons"] for r in rejected}
    assert reasons == {
        3: ["sales_amount: too large: 1e30"], 4: ["sales_amount: not a number: much"], 5: ["product_id: not a whole number of 64 bits: 7.5"],
    }


@pytest.mark.parametrize("good_first", [True, False])
@pytest.mark.parametrize("multiline", [True, False])
def test_quoted_line_break(spark, tmp_path, multiline, good_first):
    fields = record(9)
    fields[HEADERS.index("Product Name")] = '"two\nlines"'
    broken, good = ",".join(fields), line(77)  # the tail of the record has 77 where a key might be
    file = write(tmp_path / "a.csv", [good, broken] if good_first else [broken, good])
    fact, rejected, audit = loaded(spark, tmp_path / "out", file, multiline)
    if multiline:
        assert set(fact) == {9, 77} and not rejected and audit["initial_rows"] == 2
    else:
        assert set(fact) == {77} and len(rejected) == 2 and audit["initial_rows"] == 3
        assert all(r["order_item_id"] is None and r["_reasons"][-1] == "malformed record" for r in rejected)
        assert any('"two' in r[MALFORMED] for r in rejected)


def test_surplus_and_missing_fields(spark, tmp_path):
    long, short = line(1) + ",x,y", ",".join(record(2)[:-3])
    fact, rejected, _ = loaded(spark, tmp_path / "out", write(tmp_path / "a.csv", [long, short, line(3), line(3)]))
    assert set(fact) == {3}
    assert sorted(r[MALFORMED] for r in rejected) == sorted([long, short])


def test_flags_and_dates(spark, tmp_path):
    flags = ["1", "1.0", "True", "0", "", "Y"]
    dates = ["2018-01-02T03:04:05", "2018-01-02 03:04", "1/2/2018 3:04 ", "2018-01-02", "2018-01-02T03:04:05.123", "1/2/2018"]
    file = write(tmp_path / "a.csv", [line(i, late_delivery_risk=f, order_date=d) for i, (f, d) in enumerate(zip(flags, dates))])
    fact, rejected, _ = loaded(spark, tmp_path / "out", file)
    assert not rejected and [fact[i]["late_delivery_risk"] for i in range(6)] == [1, 1, 1, 0, 0, 0]
    assert fact[0]["order_date"] == datetime(2018, 1, 2, 3, 4, 5) and fact[1]["order_date"] == datetime(2018, 1, 2, 3, 4)
    assert fact[4]["order_date"] == datetime(2018, 1, 2, 3, 4, 5, 123000)
    text = spark.createDataFrame([(i, f or None) for i, f in enumerate(flags)], "i int, late_delivery_risk string")
    got = by(cleaning.normalize_risk_flag(text), "i")
    assert [got[i]["late_delivery_risk"] for i in range(6)] == [1, 1, 1, 0, 0, 0]


def quoted(rng, width):
    """A record of a file with odd texts: breaks, quotes and commas inside quotes, empty and blank fields."""
    texts = ["plain", "", " ", '"a, b"', '"two\nlines"', '"say ""x"""', '"""\n\n,"""', "\xe9", '"\n"', '" "', "NA", '"x\n\ny"']
    return ",".join(rng.choice(texts) if rng.random() < 0.2 else f"f{k}" for k in range(width))


@pytest.mark.parametrize("bytes_a_block", [300, 100_000])
def test_records_of_several_lines_as_the_whole_file_reader_gives_them(spark, tmp_path, bytes_a_block):
    rng = random.Random(bytes_a_block)
    for n in range(4):
        body = [quoted(rng, 3) for _ in range(rng.choice([0, 1, 80]))]
        body += ["a,b", "a,b,c,d", ""] if n == 2 else []  # malformed and empty lines
        rng.shuffle(body)
        text = "\n".join(["x,y z,w (q)", *body]) + ("\n" if n != 1 else "")
        (tmp_path / f"{n}.csv").write_text(text, encoding="latin-1")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_a_block))
    try:
        found = read_raw_orders(spark, str(tmp_path), position=True, multiline=True)
        got = sorted(map(str, found.drop("_source_position").collect()))
        places = [(r.file, r.block, r.row) for r in found.select("_source_position.*").collect()]
        tasks = raw_orders._lines(spark, str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    names = ["x", "y z", "w (q)"]
    fields = ", ".join(f"`{n}` STRING" for n in [*names, MALFORMED])
    whole = (
        spark.read.schema(fields).option("header", True).option("encoding", "ISO-8859-1").option("quote", '"').option("escape", '"')
        .option("multiLine", True).option("columnNameOfCorruptRecord", MALFORMED).csv(str(tmp_path))
    )
    want = whole.select(*[F.expr(f"CASE WHEN `{n}` NOT IN ('', 'NA') THEN `{n}` END").alias(n) for n in names], MALFORMED)
    assert got == sorted(map(str, want.collect()))
    assert len(set(places)) == len(places) and (tasks > 4 if bytes_a_block == 300 else tasks <= 4)


def test_an_open_quote_and_another_header(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_orders, "MOST_LINES", 5)
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,\"open\n" + "4,5\n" * 9, encoding="latin-1")
    got = read_raw_orders(spark, str(tmp_path), multiline=True).collect()
    assert len(got) == 11 and sum(r[MALFORMED] is None for r in got) >= 1
    (tmp_path / "b.csv").write_text("y,x\n1,2\n", encoding="latin-1")
    with pytest.raises(Exception, match="another header"):
        read_raw_orders(spark, str(tmp_path), multiline=True).collect()


def test_a_column_has_one_layout_of_dates(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    day = ["13/2/2018 10:00", "3/4/2018 10:00", "2018-05-06 07:08", "31/12/2018", "12/31/2018"]  # the last one fits no day first
    month = ["2/13/2018 10:00", "3/4/2018 10:00", "2018-05-06 07:08", "12/31/2018", "1/1/2018"]
    unclear = ["3/4/2018 10:00"] * 5
    for name, dates in (("a", day), ("b", month), ("c", unclear)):
        base = "abc".index(name) * 10
        write(folder / f"{name}.csv", [line(base + i, order_date=d, shipping_date=month[i]) for i, d in enumerate(dates)])
    fact, rejected, _ = loaded(spark, tmp_path / "out", str(folder))
    read = {k: r["order_date"] for k, r in fact.items()}
    assert [read[k] for k in (0, 1, 2, 3)] == [datetime(2018, 2, 13, 10), datetime(2018, 4, 3, 10), datetime(2018, 5, 6, 7, 8), datetime(2018, 12, 31)]
    assert [r["order_item_id"] for r in rejected] == [4]
    assert [read[k] for k in (10, 11, 12, 13)] == [datetime(2018, 2, 13, 10), datetime(2018, 3, 4, 10), datetime(2018, 5, 6, 7, 8), datetime(2018, 12, 31)]
    assert all(read[k] == datetime(2018, 3, 4, 10) for k in range(20, 25))
    assert {fact[k]["shipping_date"] for k in (0, 10, 20)} == {datetime(2018, 2, 13, 10)}  # each column has its own vote
    votes = {(r["file"][-5], r["column_name"]): r for r in rows(read_table(spark, "dq_date_layouts", root=str(tmp_path / "out")))}
    assert len(votes) == 6
    assert votes["a", "order_date"]["layout"] == "day first" and votes["a", "shipping_date"]["layout"] == "month first"
    assert votes["a", "order_date"]["slashed_dates"] == 4 and votes["a", "order_date"]["day_first_only"] == 2
    assert votes["c", "order_date"]["ambiguous"] == 5 and votes["c", "order_date"]["ambiguous_share"] == 1.0
