"""Whitening against numpy's eigenvectors, and on odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from purchase_signals.llm.queries import op11_whitening
from purchase_signals.llm.whitening import eigenvectors, polar_factor, whiten

SF = "/root/testdata/sf0.01"


def symmetric(values, draw):
    q, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    made = (q * values) @ q.T
    return 1000 * (made + made.T) / 2


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 64, 150])
@pytest.mark.parametrize("kind", ["spread", "decay", "cluster", "lowrank", "equal", "signs", "diagonal"])
def test_eigenvectors(n, kind):
    draw = np.random.default_rng(n)
    values = {
        "spread": draw.random(n) + 0.1,
        "decay": 10.0 ** -np.linspace(0, 12, n),
        "cluster": np.repeat(draw.random(-(-n // 4)), 4)[:n] + 1e-13 * draw.random(n),
        "lowrank": np.where(np.arange(n) < n // 2 + 1, draw.random(n), 0),
        "equal": np.ones(n),
        "signs": draw.standard_normal(n),
        "diagonal": np.arange(n) + 1.0,
    }[kind]
    matrix = np.diag(values) if kind == "diagonal" else symmetric(values, draw)
    norm = np.linalg.norm(matrix)
    found, vectors = eigenvectors(matrix)
    assert np.abs(found - np.sort(np.linalg.eigvalsh(matrix))[::-1]).max() <= 1e-13 * norm
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() <= 1e-13
    assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-13 * norm


def test_polar_factor_is_the_sign_of_a_symmetric_matrix():
    draw = np.random.default_rng(0)
    for low in (1.0, 1e-3, 1e-8, 1e-13):
        values = np.concatenate([[low, -low], draw.standard_normal(20)])
        q, _ = np.linalg.qr(draw.standard_normal((22, 22)))
        matrix = (q * values) @ q.T
        sign = polar_factor((matrix + matrix.T) / 2)
        assert np.abs(sign @ sign - np.eye(22)).max() < 1e-12
        assert np.abs(sign - (q * np.sign(values)) @ q.T).max() < 1e-14 / low + 1e-12


def expected(vectors, most=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = apart / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:most], components[:, ::-1][:, :most]
    return n, (apart * apart).sum(axis=1), centred @ components / np.sqrt(values), values / (centred**2).sum() * n


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, whitened, explained = expected([r["embedding"] for r in rows])
    got = op11_whitening(spark, SF).orderBy("vec_id", "component").collect()
    number = whitened.shape[1]
    assert len(got) == n * number and {r["n"] for r in got} == {n}
    assert [r["vec_id"] for r in got[::number]] == [r["vec_id"] for r in rows]
    assert [r["component"] for r in got[:number]] == list(range(1, number + 1))
    assert [r["deviation"] for r in got] == np.repeat(deviation, number).tolist()
    mine = np.array([r["whitened"] for r in got]).reshape(n, number)
    sign = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine * sign - whitened).max() < 1e-9
    assert np.allclose([r["explained"] for r in got[:number]], explained, rtol=1e-10)
    covariance = np.cov(mine.T, bias=True)
    error = {r["identity_error"] for r in got}
    assert len(error) == 1 and max(error) < 1e-10
    assert np.abs(covariance - np.eye(number)).max() < 1e-10


def odd_rows():
    draw = np.random.default_rng(1)
    rows = [(i % 40, [float(c) for c in draw.standard_normal(4)]) for i in range(120)]
    rows += [(None, [1.0, 2.0, 3.0, 4.0])] * 2 + [(7, [0.5, 0.5]), (8, [])]
    wrong = [(1, None), (2, [1.0, None, 1.0, 1.0]), (3, [float("nan")] * 4), (4, [float("inf")] * 4), (5, [float("-inf"), 0, 0, 0])]
    return rows, [(k, None if v is None else [None if c is None else float(c) for c in v]) for k, v in wrong]


def test_odd_rows(spark):
    """Null, unusable, short and repeated vectors, rows without a key, clashing columns."""
    rows, wrong = odd_rows()
    frame = spark.createDataFrame(rows + wrong, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS n", "2 AS component", "3 AS whitened", "4 AS _vector", "5 AS part"
    )
    got = whiten(frame).collect()
    assert len(got) == 4 * len(rows) and {r["n"] for r in got} == {len(rows)}
    assert sum(r["vec_id"] is None for r in got) == 8
    filled = np.zeros((len(rows), 4))
    for i, (_, vector) in enumerate(rows):
        filled[i, : len(vector)] = vector
    x = np.floor(64 * filled).astype(np.int64) + 1_000_000
    want = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert sorted(r["deviation"] for r in got) == sorted(np.repeat(want, 4).tolist())
    assert max(r["identity_error"] for r in got) < 1e-10


def test_without_spread_there_are_no_components(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        assert whiten(spark.createDataFrame(rows, schema)).collect() == []
    # Three points on a line: one component, which explains all.
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(3)]
    got = whiten(spark.createDataFrame(line, schema)).collect()
    assert len(got) == 3 and all(abs(r["explained"] - 1) < 1e-12 for r in got)
    assert sorted(round(abs(r["whitened"]), 9) for r in got) == [0.0, round(1.5**0.5, 9), round(1.5**0.5, 9)]


def test_many_partitions_and_empty_ones(spark):
    rows, _ = odd_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    few = {(r["vec_id"], r["component"], r["deviation"]) for r in whiten(frame.coalesce(1)).collect()}
    many = {(r["vec_id"], r["component"], r["deviation"]) for r in whiten(frame.repartition(200)).collect()}
    assert few == many


def test_what_does_not_fit_a_long_is_refused(spark):
    rows = [(1, [1e300, 0.0]), (2, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="OverflowError"):
        whiten(frame.where(F.lit(True))).collect()
