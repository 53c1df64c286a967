"""Every operator on nulls, empty and long texts, ties, repeated rows, other columns, no rows."""

import pytest

import corpus_pipeline
from tests.llm.corpus import SCHEMA, frame, odd_rows
from tidemark.llm import (
    bpe,
    exact_dedup,
    gam,
    jaccard_join,
    line_runs,
    lm_scoring,
    packing,
    quality_rules,
    substring_dedup,
    token_counts,
)

ONE_EACH = {
    "quality_rules": quality_rules.quality_rules,
    "quality_scores": lambda docs: gam.quality_scores(docs, gam.fit_scores(docs, labels(docs))),
    "jaccard_join": jaccard_join.jaccard_join,
    "encode": lambda docs: bpe.decode(bpe.encode(docs, chunk_chars=200, overlap_chars=40)),
    "lm_scores": lm_scoring.lm_scores,
    "exact_dedup": exact_dedup.exact_dedup,
    "substring_dedup": substring_dedup.substring_dedup,
}


def labels(docs):
    return docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality", "0 AS toxic")


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows())


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ONE_EACH)
def test_one_row_per_row(odd, name):
    found = ONE_EACH[name](odd).select("doc_id").collect()
    assert sorted(str(row.doc_id) for row in found) == sorted(str(i) for i, _ in odd_rows())


@pytest.mark.parametrize("name", ONE_EACH)
def test_no_rows(none, name):
    assert ONE_EACH[name](none).count() == 0


def test_line_runs_has_one_row_per_id_and_text(odd, none):
    found = line_runs.line_runs(odd).collect()
    assert len(found) == len(odd_rows())
    assert line_runs.line_runs(none).count() == 0


def test_pieces_hold_all_ids(odd, none):
    pieces = packing.packed(odd).collect()
    assert sum(piece.start == 0 for piece in pieces) == len(odd_rows())
    assert packing.packed(none).count() == 0


def test_histogram_counts_all_rows(odd, none):
    found = token_counts.length_histogram(odd).collect()
    assert sum(row.n_docs for row in found) == len(odd_rows())
    assert min(row.n_tokens for row in found) == 0
    empty = token_counts.length_histogram(none)
    assert empty.count() == 0
    assert token_counts.quantiles(empty, [0.5]) == {0.5: None}
    assert token_counts.cut_totals(empty, [10]) == {10: 0}


@pytest.mark.parametrize("name", ["exact_dedup", "jaccard_join", "substring_dedup"])
def test_kept_rows_have_all_columns(odd, none, name):
    operator = {
        "exact_dedup": exact_dedup, "jaccard_join": jaccard_join, "substring_dedup": substring_dedup
    }[name]
    assert operator.deduplicated(odd).columns == odd.columns
    assert operator.deduplicated(none).count() == 0


def test_pipeline_stages_on_odd_rows(spark, odd, none, tmp_path):
    labels(odd).write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, none):
        documents = docs.withColumnRenamed("n", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, documents, str(tmp_path))
            if name != "sequences":
                assert found.columns == documents.columns
        found.collect()
