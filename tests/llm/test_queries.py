from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_neighbours import classes
from tidelane.llm import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from checks.compare import database

    return database(SMALL)


def test_one_query_per_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].partition("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(SQL) < set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows_as_sql(spark, con, name):
    from checks.compare import KINDS, rows_of

    got, want = queries.queries()[name](spark, SMALL), con.execute(SQL[name])
    kinds = {d[0]: KINDS[str(d[1])] for d in want.description}
    assert kinds == dict(got.dtypes)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(list(kinds), want.fetchall())


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in SQL])
def test_one_row_per_input_row(spark, name):
    out = queries.queries()[name](spark, SMALL)
    if name == "op4_nearest_neighbours":
        assert out.count() == 5 * spark.read.parquet(f"{SMALL}/embeddings.parquet").filter("vec_id % 50 = 0").count()
    else:
        assert out.count() == out.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_pipeline_stages(spark, tmp_path):
    docs = given = spark.read.parquet(f"{SMALL}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SMALL)
        assert out.schema.names == given.schema.names
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k == 0:
            bad = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 0")
            assert docs.join(bad, "doc_id").count() <= 0.1 * bad.count()
        if k == 1:
            rows = sorted((r.doc_id, r.text) for r in before.collect())
            kept = {rows[c][0] for c, _ in classes([t for _, t in rows]).values()}
            assert sorted(r.doc_id for r in docs.collect()) == sorted(kept)
        if k == 2:
            texts = {r.doc_id: r.text for r in docs.collect()}
            hit = 0
            for r in before.collect():
                spans = brute.secrets(r.text)[1]
                hit += bool(spans)
                assert "[secret]" in texts[r.doc_id] if spans else texts[r.doc_id] == r.text
                assert brute.secrets(texts[r.doc_id])[1] == ""
            assert hit and docs.filter("n_chars <> length(text)").count() == 0 and docs.count() == before.count()
        if k == 3:
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
            assert max(r["count"] for r in docs.groupBy("doc_id").count().collect()) <= 3
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert encoded.count() == docs.count()
    assert encoded.filter("n_tokens * 4 <> octet_length(token_ids)").count() == 0
