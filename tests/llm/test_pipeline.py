import duckdb
import pytest

import corpus_pipeline
from helio.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_pack_all_that_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        docs = corpus_pipeline.materialize(after, "test")
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = queries.QUERIES[name](spark, SF)
    columns = frame.columns
    got = sorted(tuple(r[c] for c in columns) for r in frame.collect())
    assert got == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall())
