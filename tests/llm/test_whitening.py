import numpy as np
import pytest

from seamstat.llm import whitening as W

from .conftest import SF


def plain(vectors, k=8):
    x = np.floor(np.asarray(vectors, np.float64) * 1024) + 100000
    centred = x - x.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / len(x))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return x, centred, e, centred @ u / np.sqrt(e)


def test_cholesky_and_jacobi_give_the_eigenvalues():
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (5, 5), (7, 3), (40, 40), (6, 0)):
        b = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 3, size=rank)
        a = b @ b.T
        factor, order = W.pivoted_cholesky(a)
        assert factor.shape == (d, rank)
        assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], rtol=1e-9, atol=1e-9 * max(1.0, np.abs(a).max()))
        turned = W.one_sided_jacobi(factor)
        norms = np.sort((turned * turned).sum(axis=0))[::-1]
        assert np.allclose(norms, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-8)
        gram = turned.T @ turned
        assert np.abs(gram - np.diag(np.diag(gram))).max(initial=0.0) <= 1e-12 * max(1.0, norms.max(initial=0.0))


def test_query_against_plain_whitening(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [r for r in rows if r["embedding"] is not None and all(v is not None and np.isfinite(v) for v in r["embedding"])]
    x, centred, e, want = plain([r["embedding"] for r in rows])
    got = W.op13_whitening(spark, SF).collect()
    n, k = len(rows), min(8, len(e))
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    at = {r["vec_id"]: i for i, r in enumerate(rows)}
    white = np.zeros((n, k))
    sums = [int(v) for v in x.sum(axis=0)]
    deviation = {r["vec_id"]: sum((n * int(v) - s) ** 2 for v, s in zip(x[at[r["vec_id"]]], sums)) for r in rows}
    for r in got:
        white[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] / (e[r["component"] - 1] / (centred ** 2).sum() * n) - 1) < 1e-9
        assert 0 <= r["identity_error"] < 1e-9
    sign = np.sign((white * want).sum(axis=0))
    assert np.abs(white * sign - want).max() < 1e-8


SCHEMA = "vec_id long, v array<double>, whitened string, deviation string, N string"


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [nan, 0.0, 0.0]), (5, [0.0, inf, 0.0]),
            (None, [0.0, 1.0, 0.5]), (1, [3.0, -1.0, 0.5]), (1, [3.0, -1.0, 0.5])]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(4)
    w = W.fit(df, "v")
    assert w.n == 4 and len(w.eigenvalues) == 2           # the last dimension does not vary
    out = W.whiten(df, w, "v").collect()
    assert sorted(str(r["vec_id"]) for r in out) == ["1", "1", "1", "None"]
    assert set(W.whiten(df, w, "v").columns) == {"vec_id", "v", "N", "whitened", "deviation"}
    y = np.array([r["whitened"] for r in out])
    assert np.allclose(y.mean(axis=0), 0, atol=1e-12) and np.allclose(y.T @ y / 4, np.eye(2), atol=1e-12)
    assert W.identity_error(df, w, "v") < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.25, 4.0])], [(1, [0.5]), (2, [0.5])]])
def test_nothing_that_varies(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = W.op13_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_unlike_lengths_and_huge_components_raise(spark):
    for rows in ([(1, [1.0, 2.0]), (2, [1.0])], [(1, [1e300, 0.0])]):
        df = spark.createDataFrame(rows, "vec_id long, v array<double>").coalesce(1)
        with pytest.raises(Exception, match="different lengths|scaled component"):
            W.fit(df, "v")


def test_deviation_beyond_64_bits_is_exact(spark):
    rows = [(i, [(-1.0) ** i * 2.0 ** 28]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    out = W.whiten(df, W.fit(df, "v"), "v").collect()
    assert {int(r["deviation"]) for r in out} == {(4 * 2 ** 38) ** 2}


def test_moments_join_like_one_pass():
    rng = np.random.default_rng(4)
    x = rng.integers(-10 ** 9, 10 ** 9, size=(1000, 3))
    m = W.Moments()
    for part in np.array_split(x, 7):
        m.add(W.of_rows(part))
    c = x - x.mean(axis=0)
    assert m.sums == x.sum(axis=0).tolist() and np.allclose(m.scatter, c.T @ c, rtol=1e-12)
