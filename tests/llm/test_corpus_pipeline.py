"""The pipeline against a brute-force version of what its stages decide."""

import zlib

import numpy as np
import pytest
from cases import shingles, words

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def linked(a, b):
    common = len(a & b)
    return bool(a and b) and 100 * common >= 75 * (len(a) + len(b) - common)


def test_stages_on_small_tables(spark, sf_small):
    documents = spark.read.parquet(f"{sf_small}/documents.parquet")
    kept = corpus_pipeline.keep_known_languages(spark, documents, sf_small)
    assert kept.columns == documents.columns
    lettered = [r for r in documents.collect() if any(c.isalpha() for c in r.text or "")]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in lettered}

    single = corpus_pipeline.keep_one_of_similar(spark, kept, sf_small)
    sets = {r.doc_id: shingles(r.text) for r in lettered}
    parent = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and parent[a] != parent[b] and linked(sets[a], sets[b]):
                low, high = sorted((parent[a], parent[b]))
                parent = {d: low if p == high else p for d, p in parent.items()}
    assert {r.doc_id for r in single.collect()} == {d for d, p in parent.items() if d == p}

    clean = corpus_pipeline.drop_leaked(spark, single, sf_small)
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    expected = {
        d
        for d, p in parent.items()
        if d == p and not any(i and 100 * len(i & sets[d]) >= 75 * len(i) for i in items)
    }
    assert {r.doc_id for r in clean.collect()} == expected

    mixed = corpus_pipeline.mix_sources(spark, clean, sf_small)
    assert mixed.columns == documents.columns
    assert {r.doc_id for r in mixed.collect()} <= expected
    total = sum(len(words(r.text)) for r in clean.collect())
    assert sum(len(words(r.text)) for r in mixed.collect()) == pytest.approx(total, rel=0.25)


def test_near_copies_under_one_id_go(spark, documents_of, sf_small):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, passage), (1, passage + " tail"), (2, passage + " more"), (1, "quite another text with words")]
    rows += [(1, passage), (None, passage + " x"), (None, "alone in the world it stands"), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_similar(spark, docs, sf_small).collect()), key=str)
    assert len(kept) == 4 and {r[0] for r in kept if r[1].startswith("word0")} == {1}
    assert sum(r[1].startswith("word0") for r in kept) == 1
    assert (1, "quite another text with words") in kept and (3, "") in kept
    assert (None, "alone in the world it stands") in kept


def test_odd_documents(spark, odd, none, sf_small):
    for docs in (odd.drop("label"), none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.columns
            docs = stage(spark, docs, sf_small)
            assert docs.columns == before
        digest = corpus_pipeline.write_tokens(spark, docs, sf_small)
        assert digest.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert digest.count() == docs.count()


def test_run_equals_its_stages(spark, sf_small):
    digest = sorted(corpus_pipeline.run(spark, sf_small).collect(), key=lambda r: r.start)
    assert [r.start for r in digest] == [0, *np.cumsum([r.n_tokens for r in digest])[:-1]]
    assert all(0 <= r.ids_crc32 < 2**32 for r in digest) and zlib.crc32(b"") == 0
