"""Ranked search against scores added up document by document."""

import math
import random
import re
from collections import Counter

import pytest
from cases import CLASHES, ODD, UPPER
from pyspark.sql import functions as F
from tillroll.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(documents, items, k=rs.K):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in documents if terms(t)]
    count, words = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, held, _ in docs for t in held)
    out = []
    for item, text in items:
        scores = []
        for doc, held, n in docs:
            m = 10 + 90 * n * count // words
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                * (1000000000 * held[t] // (1000 * held[t] + 8 * m))
                for t in set(terms(text))
                if t in held
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, n + 1, d, -s) for n, (s, _, d) in enumerate(sorted(scores, key=str_last)[:k])]
    return Counter(out)


def str_last(entry):
    return entry[0], entry[1], entry[2] or 0


def run(spark, documents, items, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    clash = {c: F.lit("x") for c in [*CLASHES, "item", "bundle", "shard", "n", "terms"]}
    found = rs.search(docs.withColumns(clash).repartition(3), asked.withColumns(clash), **options)
    return Counter(tuple(r) for r in found.collect())


def corpus(seed, documents=400, items=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    def text(low, high):
        return " ".join(rng.choices(words, weights, k=rng.randrange(low, high)))

    docs = [(i, text(0, 120)) for i in range(documents)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(60)]  # copies, so ties
    asked = [(i, text(1, 25)) for i in range(items)]
    asked += [(100, docs[5][1]), (101, "unknown"), (102, "w1"), (103, "")]
    rng.shuffle(docs)
    return docs, asked


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"shard_documents": 50, "bundle_items": 7, "owner_shares": (0.02, 0.1, 0.3)},
        {"shard_documents": 1000, "owner_shares": (), "most_terms": 3},
        {"k": 3, "shard_documents": 20, "owner_shares": (0.01, 0.02, 0.05, 0.1, 0.2, 0.5)},
    ],
)
def test_scores_of_many_shards_bundles_and_owners(spark, options):
    documents, items = corpus(1)
    assert run(spark, documents, items, **options) == brute(documents, items, options.get("k", 10))


def test_odd_documents_and_items(spark):
    documents = [(r[0], r[1]) for r in ODD]
    items = [(1, "The QUICK brown fox"), (1, "the quick brown fox"), (None, "words é 漢字"), (2, None)]
    items += [(3, ""), (4, "12345 nosuchterm"), (5, "a an and id some words")]
    got = run(spark, documents, items)
    assert got == brute(documents, items)
    assert any(r[2] is None for r in got)


def test_empty_tables(spark):
    documents, items = corpus(2, 20, 3)
    assert not run(spark, [], items)
    assert not run(spark, documents, [])
    assert not run(spark, [(1, None), (2, " .. ")], items)
    assert not run(spark, documents, [(1, "nothing known")])


def test_terms_of_bytes_agree_with_the_pattern():
    text = "".join(map(chr, range(0x300))) + "Ünïcode漢字 A1b2_C3-d4"
    assert [t.decode() for t in rs.terms_of(text.encode())] == terms(text)


def test_bounds_leave_out_documents_that_cannot_win(spark, monkeypatch):
    """With owners by rarity the last bundles hold fewer documents than have any of the terms."""
    documents, items = corpus(3, 600, 10)
    kept = []
    monkeypatch.setattr(rs, "_raise_bounds", lambda b, k, f=rs._raise_bounds: kept.append(
        b.agg(F.sum(F.size("lines"))).first()[0]) or f(b, k))
    got = run(spark, documents, items, owner_shares=(0.02, 0.2), shard_documents=100)
    assert got == brute(documents, items)
    any_term = sum(
        any(t in set(terms(d)) for t in set(terms(i))) for _, i in items for _, d in documents
    )
    assert kept[-1] < any_term / 2
