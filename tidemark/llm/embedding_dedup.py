"""Near-duplicate vectors: cross-polytope tables with multiprobe buckets, candidate pairs verified by cosine.

Equal vectors of one label are one node with a weight.  A node is put, in every table, into the buckets of its
``probes`` nearest signed axes; nodes that share a bucket are compared.  A pair may meet in several buckets: it is
counted in the first table it shares, under the least common axis, which both sides can tell from their codes, so no
pair is ever written out.  For the components every bucket reports one edge per node, to the least node it is linked
with inside the bucket.  Buckets above ``block`` nodes are cut into tiles of two blocks.

Rows: vectors whose label or vec_id is null, or that are null, empty, zero, or hold null or non-finite components,
link with nothing.  Vectors of different length do not link.  A vec_id that repeats counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.polytope import nearest_axes, unit_rows, usable, vector_list
from tidemark.plans.staging import staged

BLOCK = 1024
_NODES = "label long, dim int, id long, weight long, tab int, bucket int, codes array<int>, unit array<double>"


def _placed(nodes: DataFrame, tables: int, probes: int, seed: int) -> DataFrame:
    """Every node once per bucket it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in usable(batch.column(3)):
                unit = unit_rows(matrix)
                axes = np.stack([nearest_axes(unit, t, seed, probes) for t in range(tables)], axis=1)
                codes = vector_list(np.sort(axes, axis=2).reshape(len(rows), -1))
                taken = pa.array(rows)
                for table in range(tables):
                    for k in range(axes.shape[2]):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(taken), pa.array(np.full(len(rows), matrix.shape[1], np.int32)),
                             batch.column(1).take(taken), batch.column(2).take(taken),
                             pa.array(np.full(len(rows), table, np.int32)), pa.array(axes[:, table, k]), codes,
                             vector_list(unit)],
                            names=["label", "dim", "id", "weight", "tab", "bucket", "codes", "unit"])

    return nodes.select("label", "id", "weight", "vector").mapInArrow(run, _NODES)


def _first_meeting(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First table and least axis that each pair of code tables ``[pair, table, probe]`` has in common."""
    same = one[:, :, :, None] == other[:, :, None, :]
    table = np.argmax(same.any(axis=(2, 3)), axis=1)
    at = np.arange(len(one))
    axis = np.where(same[at, table].any(axis=2), one[at, table], np.iinfo(np.int32).max).min(axis=1)
    return table, axis


def links_in_tile(ids: np.ndarray, weight: np.ndarray, block: np.ndarray, codes: np.ndarray, unit: np.ndarray,
                  table: int, bucket: int, across: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Weight linked to each node here for the first time, and the least node it hangs together with here."""
    linked = np.zeros(len(ids), np.int64)
    ones, others = [], []
    for a in range(0, len(ids), 256):
        cosine = unit[a:a + 256] @ unit[a:].T
        row, col = np.nonzero(cosine >= least)
        row, col = row + a, col + a
        keep = col > row
        if across:
            keep &= block[row] != block[col]
        row, col = row[keep], col[keep]
        for c in range(0, len(row), 100_000):
            x, y = row[c:c + 100_000], col[c:c + 100_000]
            first_table, axis = _first_meeting(codes[x], codes[y])
            new = (first_table == table) & (axis == bucket)
            linked += np.bincount(x[new], weight[y[new]], len(ids)).astype(np.int64)
            linked += np.bincount(y[new], weight[x[new]], len(ids)).astype(np.int64)
        ones.append(row.astype(np.int32))
        others.append(col.astype(np.int32))
    label = ids.copy()
    if ones:
        x, y = np.concatenate(ones), np.concatenate(others)
        while True:
            before = label.copy()
            np.minimum.at(label, x, label[y])
            np.minimum.at(label, y, label[x])
            if (before == label).all():
                break
    return linked, label


def _compared(rows: DataFrame, tables: int, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def report() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            ids, weight, block = (np.array([h[k] for h in held], np.int64) for k in range(3))
            codes = np.stack([h[3] for h in held]).reshape(len(held), tables, -1)
            linked, label = links_in_tile(ids, weight, block, codes, np.stack([h[4] for h in held]),
                                          key[2], key[3], key[4] != key[5], least)
            some = (linked > 0) | (label != ids)
            yield pa.record_batch([pa.array(ids[some]), pa.array(linked[some]), pa.array(label[some])],
                                  names=["id", "linked", "least"])

        for batch in batches:
            plain = [batch.column(k).to_pylist() for k in range(9)]
            codes = batch.column(9).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else []
            unit = batch.column(10)
            for k, row in enumerate(zip(*plain)):
                if row[:6] != key:
                    yield from report()
                    key, held = row[:6], []
                held.append((*row[6:9], codes[k], unit[k].values.to_numpy()))
        yield from report()

    columns = ["label", "dim", "tab", "bucket", "tile_a", "tile_b", "id", "weight", "block", "codes", "unit"]
    return rows.select(*columns).repartition(*columns[:6]).sortWithinPartitions(*columns[:7]).mapInArrow(
        run, "id long, linked long, least long")


def near_duplicates(vectors: DataFrame, least: float = 0.98, tables: int = 8, probes: int = 2, seed: int = 10) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding, label)``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").alias("vector"))
    sound = rows.filter(
        "vec_id is not null and label is not null and vector is not null and exists(vector, x -> x <> 0) "
        "and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    nodes = staged(sound.groupBy("label", "vector").agg(
        F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("weight")), "vector-nodes")
    placed = staged(_placed(nodes, tables, probes, seed), "vector-buckets")
    crowded = placed.groupBy("label", "dim", "tab", "bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    tiles = (
        placed.join(crowded, ["label", "dim", "tab", "bucket"])
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.expr("pmod(xxhash64(id), blocks)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("tile_a", F.least("block", "other")).withColumn("tile_b", F.greatest("block", "other"))
    )
    found = staged(_compared(tiles, tables, least), "vector-links")
    linked = found.groupBy("id").agg(F.sum("linked").alias("linked"))
    joined = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")), "vector-components")
    named = nodes.join(linked, "id", "left").join(joined, "id", "left").select(
        "label", "vector", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n"),
        F.coalesce("component", "id").alias("component"))
    return rows.join(named, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"))
