import numpy as np
import pytest
from conftest import SF001
from markbook.llm import vptree


def brute(ids, x, k, every):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = vptree.scores(np.broadcast_to(x[i], x.shape), x)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def table(spark, ids, x):
    return spark.createDataFrame([("c", int(i), [float(f) for f in v]) for i, v in zip(ids, x)],
                                 "shard string, vec_id long, embedding array<float>")


@pytest.mark.parametrize("copies", [0, 900])
def test_factor_one_is_exact_with_ties(spark, monkeypatch, copies):
    monkeypatch.setattr(vptree, "SHARD", 400)
    monkeypatch.setattr(vptree, "LEAF", 16)
    g = np.random.default_rng(2)
    x = g.standard_normal((1200, 6)).astype(np.float32) * g.uniform(0.1, 3, (1200, 1)).astype(np.float32)
    x[100:100 + copies] = x[7]
    ids = g.permutation(1200) - 50
    assert found(vptree.nearest(spark, table(spark, ids, x), every=10)) == brute(ids, x.astype(np.float64), 20, 10)


@pytest.mark.parametrize("norm", [None, 1e4, 1e9])
def test_ties_of_different_vectors_and_an_outlier(spark, monkeypatch, norm):
    """Whole-number vectors tie with many different ones; a huge norm makes lifted distances coarse."""
    monkeypatch.setattr(vptree, "SHARD", 700)
    monkeypatch.setattr(vptree, "LEAF", 32)
    monkeypatch.setattr(vptree, "PAIRS", 1 << 14)
    g = np.random.default_rng(5)
    x = g.integers(-2, 3, (3000, 16)).astype(np.float32)
    x[(x == 0).all(1)] = 1
    if norm:
        x[11] *= np.float32(norm)
    ids = g.permutation(3000)
    assert found(vptree.nearest(spark, table(spark, ids, x), every=10)) == brute(ids, x.astype(np.float64), 20, 10)


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    want = brute(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64), 20, 20)
    assert found(vptree.nearest(spark, df)) == want
    loose = found(vptree.nearest(spark, df, relax=1.15))
    recall = np.mean([len({i for i, _ in loose[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]),
            (6, [1.0, 1.0, 1.0]), (7, [0.5, 0.5]), (20, [0.0, -1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(vptree.nearest(spark, df)) == {0: [(7, 0.5), (20, 0.0)], 20: [(0, 0.0), (7, -0.5)]}
    assert vptree.nearest(spark, df.limit(0)).collect() == []
