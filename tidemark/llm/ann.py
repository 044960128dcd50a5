"""Approximate nearest neighbours by inner product: multiprobe cross-polytope tables and exact reranking.

Every vector is stored once per table, in the bucket of its nearest signed axis.  A query reads, in every table, the
buckets of its ``probes`` nearest axes and ranks all their vectors by the exact inner product in double precision.
Tables and probes follow from the vectors' length (``tables_of``, ``probes_of``), as the share of axes that must be
read for a given recall hardly falls with the length.  Up to ``GROUPS`` runs of neighbouring axes are a group; a query
is sent once to every group with the axes it reads there, so copies do not grow with the probes.  Groups are split by
salt, so that no task holds more than ``block`` vectors of one; a query visits every salt.  Queries that found fewer
than ``k`` vectors are compared with all vectors, block by block.

Rows: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without a
vec_id.  Vectors of different length are not comparable.  A vec_id that repeats counts once, with its best score, and
is never its own neighbour.  Ties go to the smaller vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.polytope import nearest_axes, padded, unit_rows, usable, vector_list
from tidemark.plans.staging import staged

_FOUND = "query_id long, vec_id long, score double"
#: Groups of axes per table and vector length.
GROUPS = 16
#: Part of the signed axes that a query reads in every table.
PROBED = 0.3125


def tables_of(size: int) -> int:
    """Tables for vectors of ``size`` components."""
    return 4 if size <= 64 else 6


def probes_of(size: int) -> int:
    """Axes read per table for vectors of ``size`` components."""
    return int(np.ceil(PROBED * 2 * padded(size)))


def _hashed(vectors: DataFrame, tables: int | None, probes: int | None, seed: int, asked: bool) -> DataFrame:
    """``tab, dim, part, axes, vec_id, vector``: the nearest axis of every usable vector, or, for the asked ones, the
    axes they read, listed by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, matrix in usable(batch.column(1)):
                unit, size = unit_rows(matrix), matrix.shape[1]
                width = max(1, 2 * padded(size) // GROUPS)
                for table in range(tables or tables_of(size)):
                    axes = nearest_axes(unit, table, seed, (probes or probes_of(size)) if asked else 1)
                    for part in np.unique(axes // width):
                        here = axes // width == part
                        of = np.flatnonzero(here.any(axis=1))
                        ends = np.concatenate([[0], np.cumsum(here.sum(axis=1)[of])]).astype(np.int32)
                        yield pa.record_batch(
                            [pa.array(np.full(len(of), table, np.int32)), pa.array(np.full(len(of), size, np.int32)),
                             pa.array(np.full(len(of), part, np.int32)),
                             pa.ListArray.from_arrays(pa.array(ends), pa.array(axes[here])),
                             pa.array(ids[rows[of]].astype(np.int64)), vector_list(matrix[of])],
                            names=["tab", "dim", "part", "axes", "vec_id", "vector"])

    return vectors.mapInArrow(run, "tab int, dim int, part int, axes array<int>, vec_id long, vector array<double>")


def best_in_block(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best points of every query, ties to the smaller id, scored by exact inner products."""
    out = []
    for a in range(0, len(queries), 256):
        own = query_ids[a:a + 256]
        rough = queries[a:a + 256] @ points.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            limit = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            limit = np.full(len(own), -np.inf)
        # Matrix products may round ties apart: keep a margin and score again, row by row.
        row, col = np.nonzero((rough >= (limit - 1e-9 * (1 + np.abs(limit)))[:, None]) & (rough > -np.inf))
        score = (queries[a:a + 256][row] * points[col]).sum(axis=1)
        order = np.lexsort((ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        first = np.searchsorted(row, np.arange(len(own)))
        keep = np.arange(len(row)) - first[row] < k
        out.append(pd.DataFrame({"query_id": own[row[keep]], "vec_id": ids[col[keep]], "score": score[keep]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _repeats(ids: np.ndarray) -> np.ndarray:
    """How often each id came before."""
    order = np.argsort(ids, kind="stable")
    first = np.concatenate([[True], ids[order][1:] != ids[order][:-1]])
    place = np.arange(len(ids))
    out = np.empty(len(ids), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return out


def _ranked_blocks(points: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if left.empty or right.empty:
            return found[0]
        asked, asked_ids = np.stack(right["vector"].to_list()), right["vec_id"].to_numpy(np.int64)
        stored, ids = np.stack(left["vector"].to_list()), left["vec_id"].to_numpy(np.int64)
        bucket = np.concatenate(left["axes"].to_list())
        reads = np.zeros((len(right), max(int(bucket.max()), *(int(a.max()) for a in right["axes"])) + 1), bool)
        reads[np.repeat(np.arange(len(right)), right["axes"].str.len()), np.concatenate(right["axes"].to_list())] = True
        if len(np.unique(ids)) < len(ids):  # rows that are equal count once; other rows of an id, one after another
            once = np.unique(np.column_stack([ids, bucket, stored.view(np.int64)]), axis=0, return_index=True)[1]
            stored, ids, bucket = stored[once], ids[once], bucket[once]
        turn = _repeats(ids)
        order = np.lexsort((turn, bucket))
        edges = np.flatnonzero((np.diff(bucket[order]) != 0) | (np.diff(turn[order]) != 0)) + 1
        for some in np.split(order, edges):
            who = np.flatnonzero(reads[:, bucket[some[0]]])
            if len(who):
                found.append(best_in_block(asked[who], asked_ids[who], stored[some], ids[some], k))
        best = pd.concat(found).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        best = best.drop_duplicates(["query_id", "vec_id"])
        return best[best.groupby("query_id").cumcount() < k]

    return points.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(rank, _FOUND)


def _blocks(frame: DataFrame, count: str, block: int) -> Column:
    return F.ceil(F.col(count) / block).cast("int")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, tables: int | None = None, probes: int | None = None,
            seed: int = 5, block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``vectors(vec_id, embedding)`` for every query."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id is not null")
    asked = vectors.filter(is_query)
    key = ["tab", "dim", "part"]
    points = _hashed(vectors, tables, probes, seed, False)
    probed = _hashed(asked, tables, probes, seed, True)
    # One row per table, length and group of axes, whatever the number of vectors.
    sizes = points.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    crowds = probed.groupBy(*key).agg(F.count(F.lit(1)).alias("q"))
    grid = sizes.join(crowds, key).select(
        *key, _blocks(sizes, "n", block).alias("salts"), _blocks(crowds, "q", block).alias("crowds"))
    grid = staged(grid, "ann-grid")
    cell = [*key, "salt", "crowd"]
    stored = (
        points.join(grid, key)
        .withColumn("salt", F.expr("cast(pmod(xxhash64(vec_id), salts) as int)"))
        .withColumn("crowd", F.explode(F.expr("sequence(0, crowds - 1)")))
    )
    asking = (
        probed.join(grid, key)
        .withColumn("crowd", F.expr("cast(pmod(xxhash64(vec_id), crowds) as int)"))
        .withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)")))
    )
    columns = [*cell, "axes", "vec_id", "vector"]
    found = staged(_ranked_blocks(stored.select(*columns), asking.select(*columns), cell, k), "ann-found")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = staged(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "ann-ranked")
    full = ranked.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    missing = staged(asked.join(full.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti"), "ann-missing")
    if not missing.isEmpty():
        rest = _exact(vectors, missing, k, block).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rest = rest.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        ranked = ranked.join(missing.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti"
                             ).unionByName(rest.select(ranked.columns))
    return ranked.select("query_id", "rank", "vec_id", "score")


def _exact(vectors: DataFrame, asked: DataFrame, k: int, block: int) -> DataFrame:
    """Every asked vector against all vectors of its length, in blocks."""
    def plain(frame: DataFrame) -> DataFrame:
        return _hashed(frame, 1, 1, 0, False).select("dim", F.array(F.lit(0)).alias("axes"), "vec_id", "vector")

    points, queries = plain(vectors), plain(asked)
    sizes = points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).join(
        queries.groupBy("dim").agg(F.count(F.lit(1)).alias("q")), "dim").select(
        "dim", F.ceil(F.col("n") / block).cast("int").alias("salts"), F.ceil(F.col("q") / block).cast("int").alias("crowds"))
    stored = points.join(sizes, "dim").withColumn("salt", F.expr("cast(pmod(xxhash64(vec_id), salts) as int)")).withColumn(
        "crowd", F.explode(F.expr("sequence(0, crowds - 1)")))
    asking = queries.join(sizes, "dim").withColumn(
        "crowd", F.expr("cast(pmod(xxhash64(vec_id), crowds) as int)")).withColumn(
        "salt", F.explode(F.expr("sequence(0, salts - 1)")))
    columns = ["dim", "salt", "crowd", "axes", "vec_id", "vector"]
    return _ranked_blocks(stored.select(*columns), asking.select(*columns), columns[:3], k)
