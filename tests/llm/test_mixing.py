import random
from collections import defaultdict

import pytest
from cases import words
from tillroll.llm.mixing import apply_mix, apportion, mix

WEIGHTS = (5, 2, 1)


def targets(sizes):
    """Excess reshared by weight until none is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


def sainte_lague(weights, seats, most):
    won = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if won[i] < most[i] and weights[i] > 0]
        if not open_:
            break
        won[max(open_, key=lambda i: (weights[i] / (2 * won[i] + 1), -i))] += 1
    return won


@pytest.mark.parametrize("seats", [0, 3, 57, 400])
def test_highest_quotients_win(spark, seats):
    random.seed(seats)
    weights = [random.choice([0, 1, 7, 19.5, 300, 1000.25]) + random.random() for _ in range(9)]
    most = [random.choice([2, 40, 10_000]) for _ in weights]
    claims = spark.createDataFrame(
        [(1, i, w, seats, m) for i, (w, m) in enumerate(zip(weights, most, strict=True))],
        "g int, i int, w double, seats long, most long",
    ).coalesce(1)
    won = {r.i: r.won for r in apportion(claims, ["g"], "w", "seats", "most", "won").collect()}
    assert [won[i] for i in range(len(weights))] == sainte_lague(weights, seats, most)


def test_targets_and_takes(documents_of):
    random.seed(3)
    rows = [
        (i, " ".join(["w"] * random.randint(0, 400)), "en", random.choice(["a", "b", "é", None, "c"]))
        for i in range(300)
    ] + [(1000, "tiny", "en", "d"), (1001, None, "en", "e"), (1002, "", "en", None)]
    mixed = mix(documents_of(rows), shard_words=5000)
    first = sorted(tuple(r) for r in mixed.collect())
    assert first == sorted(tuple(r) for r in mix(documents_of(rows), shard_words=5000).collect())
    sizes, taken, told = defaultdict(int), defaultdict(int), {}
    source = {doc: s for doc, _, _, s in rows}
    text = {doc: t for doc, t, *_ in rows}
    for doc, size, source_size, target, words_taken, *_ in first:
        assert size == len(words(text[doc])) and 0 <= words_taken <= 3 * size
        sizes[source[doc]] += size
        taken[source[doc]] += words_taken
        told[source[doc]] = (source_size, target)
    for name, target in targets(sizes).items():
        assert told[name] == (sizes[name], pytest.approx(target))
        assert abs(taken[name] - target) <= 0.03 * target + 3


def test_whole_copies_keep_to_what_is_taken_of_each_source(documents_of):
    """Also where a source has few and long documents."""
    random.seed(4)
    rows = [
        (i, " ".join(["w"] * int(random.paretovariate(1.1) * 20)), "en", random.choice("aaabbc"))
        for i in range(900)
    ] + [(5000 + i, " ".join(["w"] * 3000), "en", "d") for i in range(6)]
    documents = documents_of(rows)
    mixed = mix(documents, shard_words=20_000).cache()
    wanted, given, largest, shards = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    source = {doc: s for doc, _, _, s in rows}
    size = {r.doc_id: r.size for r in mixed.collect()}
    for r in mixed.collect():
        wanted[source[r.doc_id]] += r.taken
        shards[source[r.doc_id]].add(r.shard)
    counts = defaultdict(int)
    for r in apply_mix(documents, mixed).collect():
        given[r.source] += size[r.doc_id]
        counts[r.doc_id] += 1
    for r in mixed.collect():
        assert abs(counts[r.doc_id] - r.taken / max(1, r.size)) < 1
        largest[source[r.doc_id], r.shard] = max(largest[source[r.doc_id], r.shard], r.size)
    for name in wanted:
        assert abs(given[name] - wanted[name]) <= sum(n for (s, _), n in largest.items() if s == name)
    assert sum(given.values()) == pytest.approx(sum(wanted.values()), rel=0.05)
    mixed.unpersist()


def test_odd_documents(odd, none):
    got = mix(odd).collect()
    assert len(got) == odd.count()
    assert all(r.taken <= 3 * r.size for r in got)
    assert mix(none).count() == 0
    assert apply_mix(none, mix(none)).count() == 0
    kept = apply_mix(odd, mix(odd))
    assert kept.columns == odd.columns
    assert all(words(r.text) for r in kept.collect())
