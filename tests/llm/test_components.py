"""Connected components against a plain search, and how often the edges are computed."""

import random

from tillroll.llm.components import connected_components


def brute(edges):
    label = {}
    for a, b in edges:
        if a is not None and b is not None:
            label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and b is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def test_components_of_odd_graphs(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 600)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges += [(7, 7), (None, 3), (4, None), (-5, 9), (9, -5)]
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == brute(edges)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(i, i // 2) for i in range(50)], "a long, b long")
    found = connected_components(edges.mapInArrow(counted, "a long, b long"))
    assert found.count() == 50 and seen.value == 50
