"""The registered queries against their SQL, and the pipeline against its operators."""

import importlib

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.test_catalog import FOLDER, as_text
from tidemark.llm import packing
from tidemark.llm.queries import QUERIES, SQL
from tidemark.session import cut


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, name):
    found = entry_points.queries()[name](spark, FOLDER).toPandas()
    expected = duck.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert as_text(found) == as_text(expected)


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == [*range(1, 14)]
    assert "pipeline" in entry_points.queries()


def test_pipeline_equals_its_operators(spark, duck):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scores = QUERIES["op2_gam"](spark, FOLDER).toPandas().set_index("doc_id").predicted
    good = cut(corpus_pipeline.quality_classifier(spark, docs, FOLDER))
    texts = {row.doc_id: row.text for row in good.collect()}
    assert set(texts) == {i for i, predicted in scores.items() if predicted}
    # Each later stage is judged by the operator's SQL over what the stage was given.
    def view(frame):
        duck.register("given", frame.toPandas())
        duck.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM given")

    view(good)
    first = duck.execute(SQL["op9_exact_dedup"]).df().query("kept").doc_id
    single = cut(corpus_pipeline.exact_copies(spark, good, FOLDER))
    assert {row.doc_id for row in single.collect()} == set(first)
    view(single)
    heads = duck.execute(SQL["op3_jaccard_join"]).df().query("doc_id == component_id").doc_id
    unlike = cut(corpus_pipeline.near_copies(spark, single, FOLDER))
    assert {row.doc_id for row in unlike.collect()} == set(heads)
    view(unlike)
    rest = duck.execute(SQL["op10_substring_dedup"]).df()
    short = cut(corpus_pipeline.repeated_passages(spark, unlike, FOLDER))
    assert {(r.doc_id, r.text, r.n_chars) for r in short.collect()} == {
        (r.doc_id, r.text, len(r.text)) for r in rest.itertuples()
    }
    duck.execute("DROP VIEW IF EXISTS temp.documents")
    pieces = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    totals = {}
    for row in packing.digests(packing.packed(short)).select(*pieces).collect():
        totals[row.doc_id] = totals.get(row.doc_id, 0) + row.length
    run = corpus_pipeline.run(spark, FOLDER).select(*pieces).collect()
    found = {}
    for row in run:
        found[row.doc_id] = found.get(row.doc_id, 0) + row.length
        assert row.doc_tokens >= row.start + row.length
    assert found == totals == {row.doc_id: row.doc_tokens for row in run}


def test_import_errors_are_not_swallowed():
    assert importlib.import_module("tidemark.llm.queries").QUERIES is QUERIES
