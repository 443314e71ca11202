import random

from cases import PASSAGE, shingles
from tillroll.llm import decontamination
from tillroll.llm.decontamination import decontaminate, find_items, item_table, signatures

ITEMS = [
    (1, PASSAGE), (2, "two words"), (3, None), (4, " "), (5, "some words in it"),
    (6, "an item that is found nowhere at all"), (6, PASSAGE.upper()),
]


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, "k", "h") for r in rows], "item_id long, text string, key string, hash string")


def brute(docs, items):
    found = {}
    for item, text in items:
        own = shingles(text)
        if not own:
            continue
        width = len(next(iter(own)))
        merged = {}
        for doc, body, *_ in docs:
            mine = shingles(body, width)
            merged.setdefault(doc, set()).update(s for s in mine if len(s) == width)
        for doc, mine in merged.items():
            common = len(own & mine)
            if 100 * common >= 75 * len(own):
                best = found.get((doc, item), (0, 0, 0))
                found[doc, item] = max(best, (common / len(own), len(own), common))
    return {k: v[1:] for k, v in found.items()}


def result(df):
    return {(r.doc_id, r.item_id): (r.n_shingles, r.n_common) for r in df.collect()}


def test_odd_documents_and_items(spark, odd):
    from cases import ODD

    got = result(find_items(odd, benchmark(spark, ITEMS)))
    assert got == brute(ODD, ITEMS) and (2, 1) in got and (None, 5) in got
    left = decontaminate(odd, benchmark(spark, ITEMS))
    assert left.columns == odd.columns
    leaked = {d for d, _ in got}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(r[0]) for r in ODD if r[0] not in leaked
    )


def test_rows_of_one_id_go_by_their_own_text(spark, documents_of):
    import corpus_pipeline

    item = " ".join(f"w{i}" for i in range(24))
    docs = [
        (doc, text, "en", "a") for doc in (None, 7) for text in (item, "a clean text", None, "another")
    ]
    path = corpus_pipeline.table
    try:
        corpus_pipeline.table = lambda *_: benchmark(spark, [(1, item)])
        left = corpus_pipeline.drop_leaked(spark, documents_of(docs), "")
        none = corpus_pipeline.drop_leaked(spark, left, "")
    finally:
        corpus_pipeline.table = path
    kept = sorted(map(str, [d[:2] for d in docs if d[1] != item]))
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == kept
    assert none.count() == len(kept)
    assert decontamination.decontaminate_rows(left, benchmark(spark, [])).count() == len(kept)


def test_border_of_containment_in_long_documents(spark, documents_of):
    random.seed(4)
    vocabulary = [f"v{i}" for i in range(5000)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(5, 40)))) for i in range(30)]
    docs = []
    for i in range(60):
        text = items[i % 30][1].split()
        for _ in range(random.randint(0, 3)):
            text[random.randrange(len(text))] = "changed"
        around = random.choices(vocabulary, k=random.choice([0, 10, 4000]))
        cut = random.randint(0, len(around))
        docs.append((i, " ".join(around[:cut] + text + around[cut:]), "en", "a"))
    got = result(find_items(documents_of(docs), benchmark(spark, items)))
    assert got == brute(docs, items) and 10 < len(got) < 60


def test_empty_tables(spark, odd, none):
    assert find_items(none, benchmark(spark, ITEMS)).count() == 0
    assert find_items(odd, benchmark(spark, [])).count() == 0
    assert decontaminate(odd, benchmark(spark, [])).count() == odd.count()


def test_signatures_spare_no_more_than_an_item_can(spark):
    text = " ".join(f"w{i}" for i in range(24))  # 20 shingles: size class 17 to 32
    signed = signatures(item_table(benchmark(spark, [(1, text)])))
    assert signed.count() == 32 - 24 + 1
