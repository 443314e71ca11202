import random

import numpy as np
import pytest
from cases import ODD, shingles
from pyspark.sql import functions as F
from tillroll.llm.components import connected_components
from tillroll.llm.jaccard_join import InvertedLists, group_links, similar_documents


def linked(a, b):
    common = len(a & b)
    return bool(a and b) and 100 * common >= 75 * (len(a) + len(b) - common)


def parts(sets, link):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if link(sets[i], sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def connected(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    return label


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    label = parts(sets, linked)
    ids = {}
    for row, part in zip(rows, label, strict=True):
        if row[0] is not None:
            ids[part] = min(ids.get(part, row[0]), row[0])
    return [(r[0], len(s), ids.get(p)) for r, s, p in zip(rows, sets, label, strict=True)]


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def test_odd_documents(odd):
    got = [tuple(r) for r in similar_documents(odd).collect()]
    assert sorted(got, key=key) == sorted(brute(ODD), key=key)


def test_empty_table(none):
    assert similar_documents(none).count() == 0


def test_near_copies_and_shared_passages(documents_of):
    random.seed(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = random.choices(vocabulary, k=60)
    base = random.choices(vocabulary, k=120)
    rows = []
    for i in range(240):
        if i % 3 == 0:  # near copies of one text, some at the border
            text = list(base)
            for _ in range(random.randint(0, 8)):
                text[random.randrange(len(text))] = random.choice(vocabulary)
        elif i % 3 == 1:  # a passage that many share, in texts of their own
            text = passage + random.choices(vocabulary, k=random.choice([5, 15, 25, 90]))
        else:
            text = random.choices(vocabulary, k=random.randint(1, 60))
        rows.append((i, " ".join(text), "en", "a"))
    rows += [(500 + i, rows[i][1], "en", "a") for i in range(20)]
    got = [tuple(r) for r in similar_documents(documents_of(rows)).collect()]
    assert sorted(got) == sorted(brute(rows))


@pytest.mark.parametrize("block", [4, 9, 60])
def test_large_groups_are_cut_into_blocks(documents_of, block):
    """Groups far beyond a block: a dense one, chains of sets that link with their neighbours
    only, and several parts in one group."""
    random.seed(block)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = random.choices(vocabulary, k=90)
    rows = []
    for i in range(110):
        text = list(base)
        for _ in range(random.randint(0, 9)):
            text[random.randrange(len(text))] = random.choice(vocabulary)
        rows.append(text)
    text = random.choices(vocabulary, k=80)
    for _ in range(60):  # a chain: far ends have nothing in common
        text = [*text[4:], *random.choices(vocabulary, k=4)]
        rows.append(text)
    for n in range(4):  # parts that share a passage, too short to link
        part = base[:30] + random.choices(vocabulary, k=45)
        rows += [[*part[:-1], f"end{n}x{i}"] for i in range(15)]
    random.shuffle(rows)
    rows = [(i, " ".join(text), "en", "a") for i, text in enumerate(rows)]
    got = [tuple(r) for r in similar_documents(documents_of(rows), block=block).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_copies_do_not_grow_with_a_group_of_near_copies(spark):
    """Of n sets that hang together every one goes to the first block's tasks once; only the
    first block is copied, once for each block."""
    from tillroll.llm import jaccard_join

    schema = "node long, shingles binary"
    base = np.arange(40, dtype=np.uint64)
    rows = [(n, np.unique(np.r_[base, np.uint64(1000 + n)]).tobytes()) for n in range(400)]
    sets = spark.createDataFrame(rows, schema)
    groups = sets.select("node", F.lit(0).cast("long").alias("label"))
    seen = []
    search = jaccard_join._search

    def counted(sets, dealt, tasks):
        seen.append(dealt.groupBy("asks").count().collect())
        return search(sets, dealt, tasks)

    jaccard_join._search = counted
    try:
        edges = jaccard_join.links_in_groups(sets, groups, 8, block=50)
        found = connected_components(edges)
    finally:
        jaccard_join._search = search
    assert {r.label for r in found.collect()} == {0} and found.count() == 400
    assert sum(r["count"] for r in seen[0]) < 2.5 * 400
    assert sum(r["count"] for rows in seen[1:] for r in rows) == 0


def test_search_finds_every_link():
    random.seed(2)
    sets = []
    for _ in range(120):
        start = random.randrange(40)
        sets.append({x for x in range(start, start + random.randint(1, 40)) if random.random() < 0.95} or {1})
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    index = InvertedLists(arrays)
    for i, s in enumerate(sets):
        assert sorted(index.links(i).tolist()) == [j for j, t in enumerate(sets) if linked(s, t)]
    some = list(range(0, len(sets), 7))
    asked = {frozenset(p) for p in group_links(arrays, some)}
    assert all(linked(sets[a], sets[b]) and {a, b} & {*some} for a, b in map(tuple, asked))
    every = [(i, j) for i in some for j, t in enumerate(sets) if i != j and linked(sets[i], t)]
    assert connected(len(sets), map(tuple, asked)) == connected(len(sets), every)
    label = list(range(len(sets)))
    forest = group_links(arrays)
    assert len(forest) < len(sets)
    for a, b in forest:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    assert label == parts(sets, linked)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 5), (200, 201), (300, 300), (None, 4)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    expected = {**{i: 0 for i in range(61)}, 100: 0, 200: 200, 201: 200, 300: 300}
    assert {r.node: r.label for r in got.collect()} == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
