import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, embedding_dedup
from tidemark.llm.polytope import hadamard, nearest_axes, unit_rows
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def odd_rows(size):
    return [(900, None, 1, "x"), (901, [0.0] * size, 1, "x"), (902, [float("nan")] * size, 1, "x"),
            (903, [1.0, None] + [0.0] * (size - 2), 1, "x"), (904, [float("inf")] * size, 1, "x"), (905, [], 1, "x")]


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert nearest_axes(unit_rows(x[:, :11]), 0, 3, 4).shape == (5, 4)


def test_recall_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in QUERIES["op5_ann"](spark, sf_dir).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        scores[q] = -9
        best = ids[np.lexsort((ids, -scores))][:20].tolist()
        found = got[int(ids[q])]
        assert sorted(found) == list(range(1, 21))
        hits.append(len({v for v, _ in found.values()} & set(best)) / 20)
    assert np.mean(hits) >= 0.9


def exact_nearest(ids, x, q, k):
    scores = np.where(ids == ids[q], -np.inf, (x * x[q]).sum(axis=1))
    return ids[np.lexsort((ids, -scores))][:k].tolist()


@pytest.mark.parametrize("size, spread", [(20, 0.0), (64, 1.0), (256, 0.0), (256, 1.0), (768, 0.0), (768, 1.0)])
def test_recall_at_other_lengths_and_norms(spark, size, spread):
    rng = np.random.default_rng(size)
    x = unit_rows(rng.normal(size=(2000, size))) * np.exp(rng.normal(size=(2000, 1)) * spread)
    ids = np.arange(len(x))
    vectors = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(vectors, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = [len(got[q] & set(exact_nearest(ids, x, q, 20))) / 20 for q in ids[::20]]
    assert np.mean(hits) >= 0.9


def test_repeated_ids_count_once_with_their_best_score(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 8))
    ids = np.concatenate([np.arange(30), np.arange(30), np.full(30, 7)])
    rows = [(int(i), v.tolist(), 1, "x") for i, v in zip(ids, x)] + [(7, x[80].tolist(), 1, "y")] * 50
    best = {}
    for q in np.flatnonzero(ids % 20 == 0):
        for i, v in zip(ids, x):
            if i != ids[q]:
                key = (int(ids[q]), int(i))
                best[key] = max(best.get(key, -np.inf), float((v * x[q]).sum()))
    # Every axis is read, so the result is exact.
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=5, probes=16).collect()
    for q in (0, 20):
        ranked = sorted((-s, i) for (a, i), s in best.items() if a == q)[:5]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [i for _, i in ranked]


def test_few_and_odd_vectors(spark):
    rows = [(20 * k, [float(k % 3), 1.0, 0.5], 1, "x") for k in range(1, 6)] + odd_rows(3) + [(40, [2.0, 1.0, 0.5], 1, "y")]
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert sorted(by) == [20, 40, 60, 80, 100]
    assert all(len(v) == 4 and v == sorted(v) for v in by.values())
    assert ann.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_near_duplicates_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 5)
    rng = np.random.default_rng(4)
    x = []
    for _ in range(12):
        base = rng.normal(size=32)
        x += [base + rng.normal(size=32) * 0.12 for _ in range(rng.integers(1, 12))] + [base, base]
    labels = [int(k) if k < 2 else None for k in rng.integers(0, 3, len(x))]
    rows = [(k, np.float32(v).tolist(), g, "x") for k, (v, g) in enumerate(zip(x, labels))]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(rows + odd_rows(32), SCHEMA)).collect()}
    unit = unit_rows(np.float32(x).astype(float))
    same = np.array([[a is not None and a == b for b in labels] for a in labels])
    link = (unit @ unit.T >= 0.98) & same & ~np.eye(len(x), dtype=bool)
    part = np.arange(len(x))
    for _ in range(len(x)):
        part = np.array([min([part[i], *part[link[i]]]) for i in range(len(x))])
    for k in range(len(x)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (link[k].sum(), part[k], part[k] == k)
    for k in range(900, 906):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
