from pathlib import Path

import corpus_pipeline
from helio.session import shared_path

from .conftest import SCHEMA, rows


def test_pipeline_leaves_only_its_result_on_disk(spark, tmp_path):
    source = tmp_path / "tables"
    spark.createDataFrame(rows(), SCHEMA).write.parquet(str(source / "documents.parquet"))
    folder = Path(shared_path(spark, "probe")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    packed = corpus_pipeline.run(spark, str(source))
    left = sorted(p.name for p in set(folder.iterdir()) - before)
    assert len(left) == 1 and left[0].startswith("packing-"), left
    assert packed.count() > 0
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} <= {r[0] for r in rows()}
