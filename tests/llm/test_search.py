import numpy as np
import pytest
from pyspark.sql import functions as F

from tailframe.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(ids, x, query, k):
    scores = x @ x[np.flatnonzero(ids == query)[0]]
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:k]
    return [(int(ids[i]), scores[i]) for i in order]


def test_recall_and_exact_scores(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    got = queries.op3_ann(spark, sf_dir).toPandas().sort_values(["query_id", "rank"])
    assert set(got.query_id) == {i for i in ids if i % 20 == 0}
    found = 0
    for query, part in got.groupby("query_id"):
        want = dict(brute(ids, x, query, 20))
        found += len(set(part.vec_id) & set(want))
        assert list(part["rank"]) == list(range(1, 21)) and part.score.is_monotonic_decreasing
        own = x[np.flatnonzero(ids == query)[0]]
        assert np.allclose(part.score, [x[np.flatnonzero(ids == v)[0]] @ own for v in part.vec_id], atol=1e-12)
    assert found >= 0.95 * len(got)


def test_recall_with_many_blocks(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 17)).astype(np.float32) * rng.uniform(0.2, 3, (3000, 1)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), "") for i, v in enumerate(x)], SCHEMA)
    got = ann.search(rows, F.col("vec_id") % 100 == 0, k=10, block_rows=400, chunk_rows=7, keep=60).toPandas()
    hits = sum(len(set(p.vec_id) & {i for i, _ in brute(np.arange(3000), x.astype(float), q, 10)}) for q, p in got.groupby("query_id"))
    assert len(got) == 300 and hits >= 270


def test_ties_and_vectors_without_part(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(i, same, "") for i in range(40)] + [(100, None, ""), (101, [0.0] * 3, ""), (102, [1.0, None, 1.0], ""), (103, [float("nan"), 1.0, 1.0], ""), (104, [float("inf"), 1.0, 1.0], ""), (105, [1.0], ""), (106, [], ""), (None, same, "")]
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(q, n + 1, v, 9.0) for q, vs in ((0, [1, 2, 3, 4, 5]), (20, [0, 1, 2, 3, 4])) for n, v in enumerate(vs)]


def test_few_and_no_rows(spark):
    two = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [1.0, 1.0], "")], SCHEMA)
    assert [(r.query_id, r.vec_id, r["rank"]) for r in ann.search(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1)]
    assert ann.search(two.limit(0), F.lit(True)).count() == 0


def test_loss_prefers_small_parallel_residuals():
    x = np.random.default_rng(2).normal(size=(2000, 16)).astype(np.float32)
    parallel = {}
    for threshold in (0.01, 0.4):
        codes = ann.AnisotropicCodes.fit(x, threshold=threshold)
        at = codes._assign(x)
        back = np.concatenate([codes.books[s][at[:, s]] for s in range(8)], axis=1)
        parallel[threshold] = np.mean((((x - back) * x).sum(1) / np.linalg.norm(x, axis=1)) ** 2)
    assert parallel[0.4] < 0.7 * parallel[0.01]


def test_scan_sums_the_tables():
    x = np.random.default_rng(3).normal(size=(300, 10)).astype(np.float32)
    codes = ann.AnisotropicCodes.fit(x)
    at, packed = codes._assign(x), codes.encode(x)
    back = np.concatenate([codes.books[s][at[:, s]] for s in range(5)], axis=1)
    assert codes.scan(x[:7], packed) == pytest.approx(x[:7] @ back.T, abs=1e-4)


@pytest.mark.parametrize("noise", [0.02, 0.1, 0.3])
def test_recall_in_a_large_group_of_near_copies(spark, noise):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 64))
    x[::3] = x[0] + noise * rng.normal(size=(2000, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), "") for i, v in enumerate(x)], SCHEMA)
    got = ann.search(rows, F.col("vec_id") % 150 == 0, block_rows=3_000).toPandas()
    assert got.query_id.nunique() == 40
    for query, part in got.sort_values("rank").groupby("query_id"):
        assert list(part.vec_id) == [i for i, _ in brute(np.arange(6000), x.astype(float), query, 20)]


def test_one_query_of_an_id_with_several_vectors_and_large_components(spark):
    rows = [(1, [3e200, 1e200], ""), (1, [1.0, 0.0], ""), (2, [1e100, 0.0], ""), (3, [0.0, 2.0], ""), (4, [-1.0, -1.0], "")]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), F.col("vec_id") == 1, k=2).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 2, 1e100), (1, 2, 3, 0.0)]


def test_few_rows_are_reranked_where_scores_are_spread(spark, sf_dir, monkeypatch):
    """The codes do the sifting: without the rows in doubt most of the nearest are found already, and few rows are in doubt."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    scaled, size = ann._scaled(x)
    codes = ann.AnisotropicCodes.fit(scaled[:4_000])
    packed = codes.encode(scaled)
    q, scale = ann._scaled(x[:20])
    rough = codes.scan(q, packed) * size * scale[:, None]
    exact = x[:20] @ x.T
    error = np.abs(rough - exact) / (codes.residuals(scaled, packed) * size / 8)
    assert (error < ann.DEVIATIONS).mean() > 0.99
    least = np.sort(exact, axis=1)[:, -21]
    doubt = rough + ann.DEVIATIONS * codes.residuals(scaled, packed) * size / 8 >= least[:, None]
    assert doubt.mean() < 0.05
