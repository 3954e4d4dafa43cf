"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of a few dimensions. If two vectors are within a
squared distance, then in some block they are within that block's share of it. So every block is a
range join of its own: vectors are put in cells of the block's leading two coordinates, each also
as a guest in neighbouring cells that its range reaches, pairs in range in the whole block are
verified exactly by cosine, and a pair counts in the first block only that finds it.

Equal vectors are joined once and counted by their number. A cell with many vectors is dealt to
several tasks as pairs of tiles. A task returns a count and a root for each linked vector, never
pairs, so what it returns grows with vectors and not with links.

Defined cases: vectors that are null, empty or zero, hold null or non-finite components, or have a
null label link with nothing; vectors of different lengths do not link; rows that share a vec_id
are one vector if they are equal, and count as several links otherwise; rows with a null vec_id are
left out of linking and are their own component (null).
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.common import table, whole_groups
from helio.llm.components import components
from helio.session import materialize

THRESHOLD = 0.98
BLOCK_DIMENSIONS = 8
#: Vectors, at most, that the rotation is fitted to; any rotation gives the same links.
SAMPLE_VECTORS = 4096
#: Cells are so many ranges wide.
CELL_RANGES = 2.0
MAX_LENGTHS = 16
#: Vectors of a tile; a cell with more is dealt out as pairs of tiles.
TILE = 1024


class Blocks:
    """A rotation, its split into blocks, and each block's range."""

    def __init__(self, vectors: np.ndarray, threshold: float):
        size = vectors.shape[1]
        spread, axes = np.linalg.eigh(vectors.T @ vectors / max(1, len(vectors)) + 1e-9 * np.eye(size))
        spread, axes = spread[::-1], axes[:, ::-1]
        number = max(1, size // BLOCK_DIMENSIONS)
        # dealt round, so that every block leads with dimensions of wide spread
        self.axes = [axes[:, b::number] for b in range(number)]
        share = np.array([spread[b::number].sum() for b in range(number)])
        share = np.maximum(share / share.sum(), 0.25 / number)
        self.ranges = np.sqrt((2 - 2 * threshold) * share / share.sum()) * (1 + 1e-9) + 1e-9

    def project(self, unit: np.ndarray, b: int) -> np.ndarray:
        return unit @ self.axes[b]

    def within(self, apart: np.ndarray, b: int) -> np.ndarray:
        """Whether differences are in range in a block: row by row the same, whatever rows are near."""
        z = np.einsum("ij,jk->ik", apart, self.axes[b])
        return np.einsum("ij,ij->i", z, z) <= self.ranges[b] ** 2


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(how: Blocks):
    """A row for each block and each cell that a vector lies in or reaches, later cells only."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), 2000):
                part = frame.iloc[lo : lo + 2000]
                unit = _unit(part["vector"])
                for b, reach in enumerate(how.ranges + 1e-9):
                    width = CELL_RANGES * reach
                    y = how.project(unit, b)[:, :2]
                    y = np.hstack([y, np.zeros((len(y), 2 - y.shape[1]))])
                    cell = np.floor(y / width).astype(np.int64)
                    inside = y - cell * width
                    for dx, dy in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1)):
                        near = np.ones(len(y), dtype=bool)
                        for d, move in enumerate((dx, dy)):
                            if move > 0:
                                near &= inside[:, d] >= width - reach
                            elif move < 0:
                                near &= inside[:, d] <= reach
                        if near.any():
                            yield part[near].assign(
                                block=b,
                                x=cell[near, 0] + dx,
                                y=cell[near, 1] + dy,
                                home=dx == 0 and dy == 0,
                            )

    return deal


class _Linked:
    """Counts and roots of the vectors of one cell or pair of tiles."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray):
        self.ids, self.copies = ids, copies
        self.count = np.zeros(len(ids), dtype=np.int64)
        self.root = np.arange(len(ids))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs, each once."""
        np.add.at(self.count, a, self.copies[b])
        np.add.at(self.count, b, self.copies[a])
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            r, s = self.root[i], self.root[j]
            if r != s:
                self.root[self.root == max(r, s)] = min(r, s)

    def rows(self) -> pd.DataFrame:
        linked = self.count > 0
        return pd.DataFrame({"rep": self.ids[linked], "n": self.count[linked], "root": self.ids[self.root[linked]]})


def _join(how: Blocks, threshold: float):
    """Links within groups of rows with the same work key, sorted by it."""

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in whole_groups(frames, "work"):
            if len(group) < 2:
                continue
            # ids ascend, so the smallest index of a root is the smallest id
            group = group.sort_values("rep", ignore_index=True)
            unit, home = _unit(group["vector"]), group["home"].to_numpy()
            tile, b = group["tile"].to_numpy(), int(group["block"].iloc[0])
            low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
            out = _Linked(group["rep"].to_numpy(), group["copies"].to_numpy())
            left = np.flatnonzero(tile == low)
            right = left if low == high else np.flatnonzero(tile == high)
            y = how.project(unit, b)
            square, reach = (y * y).sum(axis=1), how.ranges[b] ** 2
            for lo in range(0, len(left), 256):
                rows = left[lo : lo + 256]
                apart = square[rows, None] + square[None, right] - 2 * (y[rows] @ y[right].T)
                near = (apart <= reach + 1e-9) & (home[rows, None] | home[None, right])
                if low == high:
                    near &= rows[:, None] < right[None, :]
                i, j = np.nonzero(near)
                i, j = rows[i], right[j]
                for at in range(0, len(i), 50_000):
                    p, q = i[at : at + 50_000], j[at : at + 50_000]
                    keep = (unit[p] * unit[q]).sum(axis=1) >= threshold
                    p, q = p[keep], q[keep]
                    first = how.within(unit[p] - unit[q], b)
                    for earlier in range(b):
                        first &= ~how.within(unit[p] - unit[q], earlier)
                    out.add(p[first], q[first])
            yield out.rows()

    return join


def _usable(rows: DataFrame) -> DataFrame:
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd
        & F.exists("vector", lambda x: x != 0)
    )


def _links(reps: DataFrame, threshold: float) -> DataFrame:
    """``rep, n, root`` for linked vectors of one length, several rows each."""
    sample = reps.select("vector").limit(SAMPLE_VECTORS).toPandas()
    if not len(sample):
        return reps.sparkSession.createDataFrame([], "rep long, n long, root long")
    how = Blocks(_unit(sample["vector"]), threshold)
    kind = reps.schema["vector"].dataType.simpleString()
    label = reps.schema["label"].dataType.simpleString()
    shape = f"rep long, label {label}, copies long, vector {kind}, block int, x long, y long, home boolean"
    cells = reps.select("rep", "label", "copies", "vector").mapInPandas(_cells(how), shape)
    key = ["label", "block", "x", "y"]
    hot = (
        cells.groupBy(*key)
        .agg(F.count("*").alias("c"))
        .where(F.col("c") > TILE)
        .select(*key, F.ceil(F.col("c") / TILE).cast("int").alias("m"))
    )
    tiled = (
        cells.join(hot, key, "left")
        .withColumn("m", F.coalesce("m", F.lit(1)))
        .withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .withColumn("low", F.least("tile", "other"))
        .withColumn("high", F.greatest("tile", "other"))
        .withColumn("work", F.concat_ws(",", *[F.col(c).cast("string") for c in [*key, "low", "high"]]))
        .select("work", "rep", "copies", "vector", "block", "home", "tile", "low", "high")
    )
    return (
        tiled.repartition("work")
        .sortWithinPartitions("work")
        .mapInPandas(_join(how, threshold), "rep long, n long, root long")
    )


def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """``rows``' id with n_links, component_id and kept, a row for each row."""
    every = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    usable = _usable(every)
    reps = materialize(
        usable.distinct().groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")),
        "vectors",
    )
    parts = [
        _links(reps.where(F.size("vector") == r["n"]), threshold)
        for r in reps.select(F.size("vector").alias("n")).distinct().limit(MAX_LENGTHS + 1).collect()
    ]
    if len(parts) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    linked = rows.sparkSession.createDataFrame([], "rep long, n long, root long")
    for part in parts:
        linked = linked.unionByName(part)
    linked = materialize(linked.groupBy("rep", "root").agg(F.sum("n").alias("n")), "vector-links")
    found = components(linked.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    sums = linked.groupBy("rep").agg(F.sum("n").alias("n"))
    known = (
        reps.join(sums, "rep", "left")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select(
            "label",
            "vector",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    # no usable vector holds a null or NaN, so what finds no match here stands alone
    placed = every.join(known, ["label", "vector"], "left").select(
        "id",
        F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return placed.withColumn("kept", kept).withColumnRenamed("id", vec_id)


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), usable AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM vectors
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), roots AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots ON roots.u = vec_id LEFT JOIN counts ON counts.u = vec_id
"""
