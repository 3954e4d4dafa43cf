import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from helio.llm import ngram_join
from helio.session import WRITTEN, materialize

from .conftest import prose
from .test_operators import brute_join


def files_of_shuffles(spark) -> int:
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()



def test_a_written_table_leaves_no_shuffle_files(spark):
    before = files_of_shuffles(spark)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    done = materialize(spark.range(20_000).repartition("id").groupBy(F.col("id") % 7).count(), "test")
    for _ in range(50):
        if files_of_shuffles(spark) <= before:
            break
        spark.sparkContext._jvm.java.lang.Thread.sleep(100)
    assert files_of_shuffles(spark) <= before
    assert done.count() == 7 and spark.conf.get(name, None) == setting


def ring() -> list[tuple[int, str]]:
    """Each document shares 14 words with the next one, and two in every fifth pair are near copies."""
    pick, out = random.Random(4), []
    shared = [prose(14, 900 + k) for k in range(61)]
    for k in range(60):
        text = f"{prose(90, 100 + k)} {shared[k]} {prose(60, 300 + k)} {shared[k + 1]} {prose(30, 500 + k)}"
        out.append((k, text))
        if k % 5 == 0:
            words = text.split()
            for _ in range(4):
                words[pick.randrange(len(words))] = f"new{k}"
            out.append((1000 + k, " ".join(words)))
    return out


def test_a_phrase_in_common_makes_no_cluster(spark, monkeypatch):
    """Before, one cluster held nearly all of these documents, and would hold nearly all of a large corpus."""
    seen = []
    plain = ngram_join._members
    monkeypatch.setattr(ngram_join, "_members", lambda reached: (seen.append(reached.groupBy("component").count().collect()), plain(reached))[1])
    rows = ring()
    got = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_join(rows)
    assert seen and max(r["count"] for r in seen[0]) <= 4


def mixed() -> list[tuple[int, str]]:
    """Groups of near copies around the bound, and documents that are mostly one of three passages."""
    out = []
    for g in range(6):
        words = prose(120 + 20 * g, 40 + g).split()
        for k in range(14):
            some = list(words)
            for x in range(k):
                some[(11 * k + 3 * x) % len(some)] = f"w{g}x{k}x{x}"
            out.append((100 * g + k, " ".join(some)))
    for p in range(3):
        passage = prose(110, 700 + p)
        for k in range(25):
            own = prose(8 + 3 * k, 2000 + 100 * p + k)
            out.append((5000 + 100 * p + k, f"{own} {passage}" if k % 2 else f"{passage} {own}"))
    for k in range(20):
        out.append((9000 + k, f"{prose(60, 3000 + k)} {prose(70, 701)} {prose(25 + k, 3100 + k)}"))
    return out


@pytest.mark.parametrize(
    ("hot", "tile", "least", "shingle", "percent"), [(2, 2048, 30, 4, 85), (2, 5, 0, 5, 80), (4, 3, 5, 3, 60)]
)
def test_no_link_is_lost(spark, hot, tile, least, shingle, percent, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "SKETCH_TILES", 2)
    monkeypatch.setattr(ngram_join, "LEAST_COMMON", least)
    rows = mixed()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.similar(docs, size=shingle, percent=percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_join(rows, shingle, percent)


def test_two_texts_of_a_document_one_blank(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 2)
    text = prose(100, 1)
    rows = [(1, text), (1, " "), (2, text + " end"), (3, "begin " + text), (4, "x " + text), (4, None), (5, prose(50, 2))]
    got = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}


def test_join_leaves_sizes_and_components_only(spark):
    first = len(WRITTEN.paths)
    found = ngram_join.similar(spark.createDataFrame(ring(), "doc_id long, text string"))
    left = WRITTEN.paths[first:]
    assert [Path(p).name.rsplit("-", 1)[0] for p in left] == ["shingle-counts", "links"]
    assert found.count() == len(ring())
    folder = Path(left[0].removeprefix("file:")).parent
    assert {p.name for p in folder.iterdir()} >= {Path(p).name for p in left}


def test_sketches_differ_in_no_more_bits_than_sets():
    random_sets = np.random.default_rng(5)
    base = np.unique(random_sets.integers(0, 1 << 63, 300, dtype=np.uint64))
    for change in (0, 1, 7, 60, 250):
        other = np.unique(np.concatenate((base[change:], random_sets.integers(0, 1 << 63, change // 2, dtype=np.uint64))))
        a, b = ngram_join.sketch(base), ngram_join.sketch(other)
        n = min(len(a), len(b)) - 1
        bits = np.bitwise_count(ngram_join._folded(a[1:], n) ^ ngram_join._folded(b[1:], n)).sum()
        assert (a[0], b[0]) == (len(base), len(other)) and bits <= len(np.setxor1d(base, other))
