"""Columns of a caller that are named like working columns of the operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helio.llm import line_dedup, ngram_join, quality, substring_dedup

NAMES = [
    "earlier", "rest", "digest", "digests", "_doc", "_lines", "_kept", "quality", "component_id", "n_shingles", "language", "selected",
    "doc", "first", "last", "h", "v", "key", "keeper", "line", "lines", "numbers", "node", "component", "tile", "cluster", "root", "side",
]


@pytest.fixture(scope="module")
def odd(docs):
    return docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in NAMES}).cache()


def kept_as_given(out, given):
    assert out.columns == given.columns
    for row in out.select("doc_id", *NAMES).collect():
        own = "none" if row["doc_id"] is None else str(row["doc_id"])
        assert [row[c] for c in NAMES] == [f"{c} of {own}" for c in NAMES]


@pytest.mark.parametrize(
    "clean", [quality.keep_good, line_dedup.clean, lambda d: ngram_join.clean(d, 5, 80), substring_dedup.clean], ids=["op5", "op8", "op9", "op3"]
)
def test_clean_leaves_other_columns_alone(docs, odd, clean):
    out = clean(odd)
    kept_as_given(out, odd)
    plain = clean(docs)
    assert sorted(map(str, out.select("doc_id", "text", "n_chars").collect())) == sorted(map(str, plain.select("doc_id", "text", "n_chars").collect()))


def test_stages_one_after_the_other(spark, odd, none):
    out, empty = odd, none
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out, empty = stage(spark, out, ""), stage(spark, empty, "")
        assert out.columns == odd.columns and empty.columns == none.columns
    kept_as_given(out, odd)
    assert out.count() and not empty.count()
