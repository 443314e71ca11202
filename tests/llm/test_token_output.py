import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import ODD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tillroll.llm import token_output
from tillroll.llm.token_output import Encoder, read_tokens, regrouped, token_digest, write_tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(FILE)


def whole(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r\x0b\x1c\x85 ᠎​ 　aB1'sé漢!_<|>", max_size=20), min_size=1, max_size=20))
def test_pieces_give_what_whole_texts_give(encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == whole(encoder, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" aZé×÷ñ.,!?;'s1\u2019\u0301ß漢", max_size=14), min_size=1, max_size=20))
def test_marks_behind_words(encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == whole(encoder, text)


@pytest.mark.parametrize("cut", [1, 3, 10])
def test_batches_are_bounded_by_bytes(cut):
    texts = ["a" * n for n in (3, 3, 3, 50, 1, 0, 4, 4)] + [None, "é" * 4]
    whole = pa.RecordBatch.from_pydict({"text": pa.array(texts), "place": list(range(10))})
    given = [whole.slice(i, cut) for i in range(0, 10, cut)] + [whole.slice(0, 0)]
    parts = [p.column("text").to_pylist() for p in regrouped(iter(given), "text", 8)]
    assert sum(parts, []) == texts
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 8 for p in parts)
    assert len(parts) == 6
    assert list(regrouped(iter([]), "text", 8)) == []


def test_forgetting_pieces_changes_no_ids(monkeypatch):
    monkeypatch.setattr(token_output, "CACHE_PIECES", 50)
    small = Encoder(FILE)
    for n in range(6):
        texts = [f"word{i * n} common words {i}é again and  again {n}" for i in range(40)] + ["", None]
        ids, bounds = small.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == whole(small, text)
        if n % 2:
            small.rest()
    assert len(small.starts) < 150


def test_round_trip(spark, odd, encoder, tmp_path):
    path = str(tmp_path / "tokens.orc")
    write_tokens(odd, path, FILE, partitions=3)
    stored = read_tokens(spark, path).collect()
    texts = {}
    for doc, text, *_ in ODD:
        texts.setdefault(doc, []).append(text or "")
    assert len(stored) == len(ODD)
    for row in stored:
        assert row.ids[-1] == 2
        assert encoder.tokenizer.decode(row.ids[:-1], skip_special_tokens=False) in texts[row.doc_id]
    digest = sorted(token_digest(spark, path).collect(), key=lambda r: r.start)
    order = [r.doc_id for r in digest]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    start = 0
    sums = {(r.doc_id, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in stored}
    for row in digest:
        assert row.start == start and (row.doc_id, row.ids_crc32) in sums
        start += row.n_tokens


def test_lookups_are_pushed_to_the_files(spark, odd, tmp_path):
    path = str(tmp_path / "tokens.orc")
    write_tokens(odd, path, FILE, partitions=2)
    found = read_tokens(spark, path).where(F.col("doc_id") == 9)
    assert "EqualTo(doc_id,9)" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 1


def test_empty_table(spark, none, tmp_path):
    path = str(tmp_path / "tokens.orc")
    write_tokens(none, path, FILE)
    assert token_digest(spark, path).count() == 0


def test_the_library_gets_some_texts_at_once(encoder, monkeypatch):
    """Texts that cannot be cut were all with the library at once."""
    own = Encoder(FILE)
    sizes = []
    inner = own.tokenizer

    class Watched:
        def encode_batch_fast(self, texts, **options):
            sizes.append(sum(map(len, texts)))
            return inner.encode_batch_fast(texts, **options)

    own.tokenizer = Watched()
    monkeypatch.setattr(token_output, "AT_ONCE", 400)
    texts = [f"two  blanks {i} and more" for i in range(100)] + ["x " * 900, ""]
    ids, bounds = own.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [
        whole(encoder, text) for text in texts
    ]
    assert len(sizes) > 5 and sum(size > 400 for size in sizes) <= 1
