"""Whitening against a dense eigensolver and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tillroll.llm import whitening as wh
from tillroll.llm.catalog import QUERIES


def usable(rows):
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in fine), default=0)
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] + [100_000] * (width - len(v)) for _, v in fine]
    return [i for i, _ in fine], x


def check(found, rows, components=8):
    """Rows of ``whiten`` against brute force, each component up to its sign."""
    ids, x = usable(rows)
    n, width = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x, strict=True)]
    exact = {}
    for i, row in zip(ids, x, strict=True):
        value = sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))
        exact.setdefault(i, []).append(value)
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, width, int((values > 1e-11 * values[0]).sum()))
    assert len(found) == n * count
    assert {r.n for r in found} == {n}
    by_component = {}
    for r in found:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, count + 1))
    for j, own in by_component.items():
        assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in own) == sorted(
            (i is None, i or 0, d) for i, ds in exact.items() for d in ds
        )
        assert own[0].explained == pytest.approx(values[j - 1] / np.trace(cov), rel=1e-9)
        assert own[0].identity_error < 1e-9
        gap = min(abs(values[j - 1] - v) for i, v in enumerate(values) if i != j - 1) if width > 1 else 1
        if gap < 1e-6 * values[0]:
            continue  # no single direction
        want = centred @ vectors[:, j - 1] / math.sqrt(values[j - 1])
        if len(set(ids)) == n and None not in ids:
            at = {r.vec_id: r.whitened for r in own}
            got = np.array([at[i] for i in ids])
            sign = np.sign(got @ want)
            assert np.abs(sign * got - want).max() < 1e-7


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    clash = {c: F.lit("c") for c in ("x", "n", "component", "task", "part", "place", "label")}
    return wh.whiten(frame.withColumns(clash), **options).collect()


def vectors(seed, count, width, scale=0.3):
    rng = np.random.default_rng(seed)
    spread = np.linspace(2, 0.5, width)
    return [(i, [float(v) for v in rng.normal(0.1, scale, width) * spread]) for i in range(count)]


@pytest.mark.parametrize(("count", "width"), [(400, 24), (300, 3), (60, 40), (5, 12)])
def test_against_dense_solver(spark, count, width):
    rows = vectors(1, count, width)
    check(run(spark, rows), rows)


def test_odd_vectors(spark):
    rows = vectors(2, 120, 6)
    rows += [(1000 + i, rows[3][1]) for i in range(80)]  # a hot vector
    rows += rows[:4] + [(None, rows[9][1]), (None, None), (7, None), (8, [None] * 6)]
    rows += [(9, [float("nan")] * 6), (10, [float("inf")] * 6), (11, [0.5, -0.5]), (12, [])]
    check(run(spark, rows), rows)


def test_no_variance_and_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, [(1, [])]) == []
    assert run(spark, [(1, [0.5, 0.25])]) == []
    assert run(spark, [(i, [0.5, 0.25]) for i in range(9)]) == []
    line = [(i, [0.1 * i, 0.2 * i, 0.0]) for i in range(50)]  # close to one direction
    check(run(spark, line), line)


def test_huge_entries_do_not_break_it(spark):
    found = run(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.5])])
    assert {r.component for r in found} == {1}
    assert {r.deviation is None for r in found} == {True, False} or all(r.deviation is None for r in found)


def test_deviation_beyond_machine_integers_is_exact():
    x = np.array([[100_000 + 10**6, 100_000]])
    base, rest, n = np.array([100_000, 100_000]), [5, -7], 3000
    assert wh.deviations(x, base, rest, n) == [(n * 10**6 - 5) ** 2 + 49]
    assert wh.deviations(x, base, rest, 10**6) == [(10**12 - 5) ** 2 + 49 if (10**12 - 5) ** 2 < 2**63 else None]


@pytest.mark.parametrize("kind", ["flat", "close", "rank", "pairs", "wide"])
def test_jacobi_davidson_reaches_double_precision(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (4000, 300 if kind == "wide" else 48))
    if kind == "close":
        x[:, :8] *= [3, 3, 3.0000001, 3, 2, 2, 2, 2]
    elif kind == "rank":
        x = x[:, :3] @ rng.normal(0, 1, (3, 48))
    elif kind == "wide":
        x *= np.linspace(3, 1, 300)
    v = x.T @ x / len(x)
    if kind == "pairs":  # equal eigenvalues
        q = np.linalg.qr(v)[0]
        v = q @ np.diag(np.repeat([9.0, 5.0, 2.0, 1.0], 12)) @ q.T
    jobs = []

    def product(block):
        jobs.append(block.shape)
        return v @ block

    values, axes = wh.leading_eigenpairs(product, len(v), 8)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1][:8]).max() < 1e-13 * values[0]
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() < 1e-14 * values[0] * 4
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-13
    assert all(shape[1] <= 10 for shape in jobs)  # never the whole matrix


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    a = q @ np.diag(np.r_[np.linspace(-3, -1, 8), np.linspace(1, 4, 12)]) @ q.T
    right = rng.normal(size=(20, 3))
    solved = wh.minres(lambda block: a @ block, right, 40, 1e-14)
    assert np.abs(a @ solved - right).max() < 1e-9


def test_sums_are_the_same_in_lanes(spark):
    rows = wh.whole_vectors(
        spark.createDataFrame(vectors(4, 200, 5), "vec_id long, embedding array<float>").repartition(9)
    )
    def total(batch):
        return wh._matrix(batch, 5, wh.OFFSET).sum(0).astype(float)

    few, many = (wh.add_up(rows, 9, (5,), total, lanes) for lanes in (64, 4))
    assert few.tolist() == many.tolist()
    sums, tasks = wh.exact_sums(rows, 5, wh.OFFSET)
    assert [float(s) for s in sums] == few.tolist() and tasks == 9


def test_query_on_its_table(spark, sf_small):
    import pyarrow.parquet as pq

    frame = pq.read_table(f"{sf_small}/embeddings.parquet").to_pydict()
    rows = list(zip(frame["vec_id"], frame["embedding"], strict=True))
    check(QUERIES["op11_embedding_whitening"](spark, sf_small).collect(), rows)
