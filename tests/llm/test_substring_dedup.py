"""Substring dedup against a plain loop over all windows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import ODD
from tillroll.llm import substring_dedup as sd


def brute(rows, length=sd.LENGTH):
    """Rows with one id and text are one document."""
    documents = {(i, t) for i, t in rows}
    split = {d: re.findall(r"[^\x20\x09-\x0D]+", d[1] or "") for d in documents}
    first = {}
    for doc, words in split.items():
        for start in range(len(words) - length + 1):
            at = (doc[0] is not None, doc[0] or 0, start)
            run = tuple(words[start : start + length])
            first[run] = min(first.get(run, at), at)
    out = []
    for row in rows:
        words = split[row]
        gone = set()
        for start in range(len(words) - length + 1):
            if first[tuple(words[start : start + length])] != (row[0] is not None, row[0] or 0, start):
                gone.update(range(start, start + length))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((row[0], len(words), len(gone), " ".join(kept)))
    return Counter(out)


def run(frame, **options):
    found = sd.drop_repeats(frame, **options).select("doc_id", "n_words", "n_removed", "kept")
    return Counter(tuple(r) for r in found.collect())


def planted(seed, documents=60, vocabulary=40):
    """Texts with shared passages at random places, near and exact copies, over few words."""
    rng = random.Random(seed)
    passages = [[f"P{p}w{rng.randrange(9)}" for _ in range(rng.randrange(18, 70))] for p in range(6)]
    rows = []
    for doc in range(documents):
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        if rows and rng.random() < 0.3:
            words = rng.choice(rows)[1].split()
            if words and rng.random() < 0.7:
                words[rng.randrange(len(words))] = "changed"
        rows.append((doc, rng.choice([" ", "\n", "\t "]).join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(spark, seed):
    rows = planted(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = run(frame)
    assert got == brute(rows)
    assert sum(r[2] for r in got.elements()) > 100


def test_periodic_words_and_short_windows(spark):
    rows = [(1, "a " * 50), (2, "a b " * 30), (3, "a " * 19), (4, "a " * 20), (5, "b a " * 9 + "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(frame) == brute(rows)
    assert run(frame, length=6, seed=3) == brute(rows, 6)


def test_odd_documents(spark, odd, none):
    rows = [(r[0], r[1]) for r in ODD]
    assert run(odd) == brute(rows)
    assert sum(run(none).values()) == 0


def test_copies_in_thousands_are_one_class(spark):
    text = " ".join(f"x{i}" for i in range(300))
    rows = [(i, text) for i in range(3000)] + [(9000 + i, f"{text} tail{i}") for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = run(frame)
    assert got[(0, 300, 0, text)] == 1
    assert sum(n for r, n in got.items() if r[2] == 300 and r[3] == "") == 2999
    assert got[(9001, 301, 300, "tail1")] == 1


def test_maximal_repeats_are_merged(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, passage), (2, f"left {passage} right"), (3, f"{passage} mid {passage}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {
        r.doc_id: [(s.start, s.words) for s in r.repeats] for r in sd.drop_repeats(frame).collect()
    }
    assert spans == {1: [], 2: [(1, 55)], 3: [(0, 55), (56, 55)]}


def test_every_window_has_its_anchor():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 5, 400).astype(np.uint64)
    bounds = np.array([0, 10, 10, 29, 49, 50, 400])
    owner, first, last, seeds, _ = sd.find_anchors(hashes, bounds)
    windows = [
        (d, s) for d in range(6) for s in range(bounds[d], bounds[d + 1] - sd.LENGTH + 1)
    ]
    owned = [
        (d, s) for d, a, b in zip(owner, first, last, strict=True) for s in range(a, b + 1)
    ]
    assert owned == windows
    assert (last - first).max() <= sd.LENGTH - sd.SEED and len(seeds) < len(windows)
