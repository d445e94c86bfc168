import math

import numpy as np
import pytest

from cohortica.llm import whitening
from cohortica.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, vector string"


def brute(vectors, k=8):
    """Numbers from numpy's own eigenvectors; whole numbers from Python's."""
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], dtype=object)
    n, total = len(x), x.sum(0)
    deviation = [int(sum((n * a - t) ** 2 for a, t in zip(row, total))) for row in x]
    z = np.array([[float(n * a - t) / n for a, t in zip(row, total)] for row in x])
    cov = z.T @ z / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return deviation, z @ q / np.sqrt(e), e / np.trace(cov)


def check(rows, ids, vectors, k=8):
    deviation, whitened, explained = brute(vectors, k)
    found = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(found) == len(rows) == len(ids) * whitened.shape[1]
    for c in range(whitened.shape[1]):
        mine = np.array([found[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(mine @ whitened[:, c])
        assert np.abs(mine * sign - whitened[:, c]).max() < 1e-8
        assert abs(found[ids[0], c + 1]["explained"] / explained[c] - 1) < 1e-9
    assert [found[i, 1]["deviation"] for i in ids] == deviation
    assert {r["n"] for r in rows} == {len(ids)}
    (error,) = {r["identity_error"] for r in rows}
    assert 0 <= error < 1e-9


def test_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(op11_whitening(spark, "/root/testdata/sf0.001").collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_odd_rows(spark):
    draw = np.random.default_rng(3)
    good = [draw.standard_normal(5).tolist() for _ in range(40)]
    rows = [(i, v, 1, 7, "x") for i, v in enumerate(good)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [math.nan] * 5), (104, [math.inf, 0.0, 0.0, 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1.0] * 9)]
    df = spark.createDataFrame(rows + [(i, v, None, 0, None) for i, v in bad], SCHEMA).repartition(3)
    good = [[float(np.float32(c)) for c in v] for v in good]
    check(whitening.whiten(df).collect(), list(range(40)), good)


def test_repeated_rows_null_ids_and_few_components(spark):
    df = spark.createDataFrame([(None, [0.0, 1.0], 0, 0, ""), (1, [1.0, 0.0], 0, 0, ""), (1, [1.0, 0.0], 0, 0, "")], SCHEMA)
    rows = whitening.whiten(df).collect()
    assert len(rows) == 3 and {r["component"] for r in rows} == {1} and {r["vec_id"] for r in rows} == {None, 1}
    assert abs(rows[0]["explained"] - 1) < 1e-12


def test_no_variance_and_empty_tables_give_no_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, 0, "")], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0, 0, "") for i in range(5)], SCHEMA)).count() == 0


def test_too_large_entries_and_too_many_dimensions_are_errors(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [3e30, 0.0], 0, 0, "")], SCHEMA)).count()
    with pytest.raises(ValueError, match="dimensions"):
        whitening.whiten(spark.createDataFrame([(1, [0.0] * 3000, 0, 0, "")], SCHEMA))


def test_deviation_beyond_64_bits_is_null():
    centre = whitening._Centre(10 ** 12, np.array([10 ** 17, 10 ** 17]))
    x = np.array([[100_000, 100_000], [100_001, 99_999], [100_000, 104_000]])
    assert centre.deviation(x) == [0, None, None]
    centre = whitening._Centre(10 ** 9, np.array([10 ** 14 + 1, 10 ** 14]))
    assert centre.deviation(np.array([[100_000, 100_000], [100_001, 100_000]])) == [1, (10 ** 9 - 1) ** 2]


@pytest.mark.parametrize("dims, spread", [(2, 1), (7, 1), (40, 1), (40, 30), (64, 8)])
def test_components_agree_with_eigenvectors(dims, spread):
    draw = np.random.default_rng(dims)
    q, _ = np.linalg.qr(draw.standard_normal((dims, dims)))
    e = np.exp(spread * draw.standard_normal(dims) / 4)
    a = q * e @ q.T
    a = (a + a.T) / 2
    found, basis = whitening.leading(a, 8)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:8]
    assert np.abs(found - want).max() < 1e-12 * want[0]
    assert np.abs(basis.T @ basis - np.eye(len(want))).max() < 1e-13
    assert np.abs(a @ basis - basis * found).max() < 1e-12 * want[0]


def test_equal_variances():
    a = np.diag([2.0, 2.0, 2.0, 1.0, 0.0, 0.0])
    turn, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((6, 6)))
    for m in (a, turn @ a @ turn.T, np.eye(4), np.zeros((3, 3))):
        found, basis = whitening.leading((m + m.T) / 2, 8)
        assert np.allclose(found, np.sort(np.linalg.eigvalsh(m))[::-1], atol=1e-13)
        assert np.abs(basis.T @ basis - np.eye(len(found))).max() < 1e-13


@pytest.mark.parametrize("condition", [1, 1e3, 1e8, 1e14])
def test_polar_factor(condition):
    draw = np.random.default_rng(1)
    u, _ = np.linalg.qr(draw.standard_normal((20, 20)))
    v, _ = np.linalg.qr(draw.standard_normal((20, 20)))
    factor = whitening.polar(u * np.geomspace(1, 1 / condition, 20) @ v.T)
    assert np.abs(factor.T @ factor - np.eye(20)).max() < 1e-12
    assert np.abs(factor - u @ v.T).max() < 1e-15 * max(condition, 1e2) * 20
