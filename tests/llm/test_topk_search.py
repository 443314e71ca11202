import math
import random

import numpy as np
import pytest
from tillroll.llm.topk_search import MTree, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, rank string"


def brute(rows, k=5, every=50):
    """Every row is a candidate for every query but itself, whatever its id."""
    usable = []
    for vec, values, *_ in rows:
        if vec is None or not values or any(v is None or not math.isfinite(v) for v in values):
            continue
        usable.append((vec, [math.floor(256 * float(np.float32(v))) for v in values]))
    out = []
    for place, (q, v) in enumerate(usable):
        if q % every == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(v, w)), c)  # noqa: B905
                for other, (c, w) in enumerate(usable)
                if other != place
            )
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 0, "v", "r") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in top_k(frame, **options).collect())


def test_odd_vectors(spark):
    random.seed(1)
    rows = [(i, [random.gauss(0, 0.3) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # a hot vector, and ties
    rows += rows[:5]
    rows += [(None, [0.1] * 6), (400, None), (450, []), (500, [None] * 6), (550, [float("nan")] * 6)]
    rows += [(600, [float("inf")] * 6), (650, [0.5, 0.5]), (700, [0.0] * 6), (50, [9.0] * 6), (-50, [0.2] * 6)]
    assert run(spark, rows) == brute(rows)


def test_rows_that_share_an_id_all_count(spark):
    rows = [(50, [1.0]), (7, [0.1]), (7, [0.9]), (8, [0.5]), (50, [-1.0])]
    assert run(spark, rows) == brute(rows)
    assert (50, 1, 7, 230 * 256) in run(spark, rows)


@pytest.mark.parametrize(("pivots", "tree_rows"), [(7, 40), (1, 25), (64, 8)])
def test_many_pivots_pieces_and_queries(spark, pivots, tree_rows):
    random.seed(2)
    rows = [(i, [random.gauss(0, 0.3) for _ in range(4)]) for i in range(500)]
    rows += [(600 + i, rows[11][1]) for i in range(150)]
    got = run(spark, rows, pivots_at_most=pivots, tree_rows=tree_rows, every=3)
    assert got == brute(rows, every=3)


def test_few_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [0.5])]) == []
    rows = [(50, [0.5]), (100, [0.25]), (3, [-1.0])]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_tree_search_is_exact_and_prunes_clusters(spread):
    random_ = np.random.default_rng(3)
    centres = random_.normal(0, 300, (20, 8))
    vectors = (centres[random_.integers(0, 20, 5000)] + random_.normal(0, 300 * spread, (5000, 8))).astype(np.int64)
    ids = random_.permutation(5000).astype(np.int64)
    length = math.sqrt((vectors.astype(float) ** 2).sum(1).max())
    tree = MTree(ids, vectors, length)
    for place in range(0, 5000, 500):
        scores = vectors @ vectors[place]
        best = np.lexsort((ids, -scores))
        best = best[ids[best] != ids[place]][:5]
        assert tree.nearest(vectors[place], int(ids[place]), 5) == [
            (int(scores[i]), int(ids[i])) for i in best
        ]
    if spread < 0.1:
        assert tree.computed < 10 * 5000 / 2
