"""Token ids of documents in ORC files, in ascending order of document id.

Documents are dealt out by ranges of their id, sorted in each range, encoded there and written
as one ORC file for each range, so no task holds more than a range and a batch. ORC run-length
encodes the integers, splits a file at stripes that are read in parallel, and keeps a row index
and a Bloom filter on ``doc_id`` with which a lookup skips stripes and row groups.

A file's columns: ``doc_id``, ``part`` (number of the range), ``first`` (ids before the
document in its range) and ``ids``. With the sum of ids of each range, one row for each, every
document knows its place in the whole.

Encoding is by the ``tokenizers`` library. Its byte-level split never joins what lies on both
sides of a blank that is followed by other than white space, so texts are cut there, each
different piece of a batch is encoded once, and of ``CACHE_PIECES`` encoded pieces those that
came up again are kept for the next batches. Texts with a blank at the end or before white space
are encoded whole. A mark behind a word is a piece of its own. Batches are put together up to
``BATCH_BYTES``, and a very long text is a batch of its own.

Defined results: a null or empty text has the end id only. Documents with one id keep one
order, by hash of the text; null ids come first. Strings of special tokens in a text are
ordinary text. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import give_back_memory, ship, store, table
from tillroll.sources.staging import new_folder

END_ID = 2
CACHE_PIECES = 600_000
#: Text that is encoded at once: much, as each different piece of a batch is looked up once.
BATCH_BYTES = 4 << 20
#: Pieces that are encoded as one text.
TOGETHER = 500
#: Characters that are with the library at once, or one text.
AT_ONCE = 1 << 18
SCHEMA = "doc_id long, part int, first long, ids array<int>"

#: A blank after which a cut could change the split: before any white space or at the end.
UNSAFE = (
    r" (?:[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}"
    r"\x{205f}-\x{206f}\x{3000}\x{feff}]|\z)"
)

_encoders: dict[str, Encoder] = {}


#: Marks behind a word. No token has both letters and marks.
MARKS = ".,;:!?"


def split_marks(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words without the mark at their end, and which of them had just one there, behind an
    ASCII or Latin-1 letter; others are left as they are."""
    stems = pc.utf8_rtrim(words, MARKS)
    cut = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy()
    ends = np.frombuffer(stems.buffers()[1], np.int32)[stems.offset : stems.offset + len(stems) + 1]
    text = np.frombuffer(stems.buffers()[2] or b"  ", np.uint8)
    long = np.diff(ends) >= 2
    last = text[np.where(long, ends[1:] - 1, 0)]
    before = text[np.where(long, ends[1:] - 2, 0)]
    ascii_letter = ((last | 32) >= ord("a")) & ((last | 32) <= ord("z"))
    # Two bytes, of which the first is C3; but the signs for times and division.
    latin = (before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    marked = (cut == 1) & long & (ascii_letter | latin)
    return pc.if_else(pa.array(marked), stems, words), marked


def _portions(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Lists of texts with so many characters at most, or of one text."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


class Encoder:
    """Encodes batches of texts; keeps the ids of pieces that it has seen.

    A piece is a word at the beginning of a text or, far more often, a blank and the word behind
    it. Both kinds are looked up as Arrow arrays, so that known words never become Python objects."""

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True
        # In a byte-level vocabulary a token has a character for each of its bytes.
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.bytes_of = np.array([len(name or "") for name in names], np.int64)
        self.ids = np.array([END_ID], np.int32)  # piece 0 is the end id
        self.starts = np.array([0], np.int64)
        self.lengths = np.array([1], np.int64)
        self.batches = np.array([0], np.int32)
        #: Known words behind a blank (True) and at a beginning (False), and their pieces.
        self.words = {kind: pa.array([], pa.string()) for kind in (True, False)}
        self.pieces = {kind: np.empty(0, np.int64) for kind in (True, False)}

    def rest(self) -> None:
        """Between tasks, keep little, as other work follows in the same process."""
        self._trim()
        give_back_memory()

    def _trim(self) -> None:
        """Forget the pieces that only one batch had; most words of a text are rare."""
        numbers = np.flatnonzero(self.batches > 1)
        numbers = np.r_[0, numbers[numbers > 0]]
        renamed = np.full(len(self.starts), -1)
        renamed[numbers] = np.arange(len(numbers))
        for kind, pieces in self.pieces.items():
            kept = renamed[pieces] > 0
            self.words[kind] = self.words[kind].filter(pa.array(kept))
            self.pieces[kind] = renamed[pieces[kept]]
        starts, self.lengths = self.starts[numbers], self.lengths[numbers]
        self.starts = np.cumsum(self.lengths) - self.lengths
        shift = np.repeat(starts - self.starts, self.lengths)
        self.ids = self.ids[shift + np.arange(len(shift))]
        self.batches = np.ones(len(numbers), np.int32)

    def _encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has. What the library returns takes a hundred
        bytes for each id, so only some texts are with it at once."""
        flat, lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for some in _portions(texts, AT_ONCE):
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            ids = [encoding.ids for encoding in found]
            del found
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())))
            lengths.append(sizes)
        return np.concatenate(flat), np.concatenate(lengths)

    def _add(self, texts: pa.Array, behind_blank: bool) -> int:
        """Encode and keep pieces; the number of the first of them.

        Those that begin with the blank they were cut at are encoded many as one text, which is
        twice as fast, and told apart by their bytes."""
        first = len(self.starts)
        if behind_blank:
            groups = (texts.slice(i, TOGETHER) for i in range(0, len(texts), TOGETHER))
            flat, _ = self._encode(" " + " ".join(group.to_pylist()) for group in groups)
            ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64) + 1)
            reached = np.cumsum(self.bytes_of[flat])
            stops = np.searchsorted(reached, ends) + 1
            if not np.array_equal(reached[stops - 1], ends):
                raise ValueError("the tokenizer joins what lies on both sides of a blank")
            lengths = np.diff(stops, prepend=0)
        else:
            flat, lengths = self._encode(text.as_py() for text in texts)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, flat])
        self.batches = np.concatenate([self.batches, np.zeros(len(lengths), np.int32)])
        return first

    def _numbers(self, words: pa.Array, behind_blank: bool) -> np.ndarray:
        """The pieces of different words."""
        place = pc.index_in(words, value_set=self.words[behind_blank])
        new = place.is_null()
        fresh = words.filter(new)
        if len(fresh):
            first = self._add(fresh, behind_blank)
            held = len(self.words[behind_blank])
            self.words[behind_blank] = pa.concat_arrays([self.words[behind_blank], fresh])
            self.pieces[behind_blank] = np.r_[
                self.pieces[behind_blank], np.arange(first, first + len(fresh))
            ]
            place = place.fill_null(-1).to_numpy().copy()
            place[new.to_numpy(zero_copy_only=False)] = np.arange(held, held + len(fresh))
        else:
            place = place.to_numpy()
        numbers = self.pieces[behind_blank][place]
        self.batches[numbers] += 1
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, and where each text's ids begin
        (one more number than texts)."""
        if len(self.starts) > CACHE_PIECES:
            self._trim()
        texts = pc.fill_null(texts, "")
        whole = np.flatnonzero(
            pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)
        )
        if len(whole):
            mask = np.zeros(len(texts), bool)
            mask[whole] = True
            cut = pc.split_pattern(pc.if_else(pa.array(mask), "", texts), " ")
        else:
            cut = pc.split_pattern(texts, " ")
        bounds = cut.offsets.to_numpy()
        bounds = bounds.astype(np.int64) - bounds[0]
        coded = cut.flatten().dictionary_encode()
        places, words = coded.indices.to_numpy(), coded.dictionary
        opening = np.zeros(len(places), bool)
        opening[bounds[:-1]] = True
        inner = np.zeros(len(words), bool)
        inner[places[~opening]] = True
        behind = words.filter(pa.array(inner))
        stems, marked = split_marks(behind)
        stems = stems.dictionary_encode()
        number = np.zeros(len(words), np.int64)
        number[inner] = self._numbers(stems.dictionary, True)[stems.indices.to_numpy()]
        mark = np.zeros(len(words), np.int64)
        if marked.any():
            last = pc.utf8_slice_codeunits(behind.filter(pa.array(marked)), -1).dictionary_encode()
            mark[np.flatnonzero(inner)[marked]] = self._numbers(last.dictionary, False)[
                last.indices.to_numpy()
            ]
        pieces, marks = number[places], mark[places]
        heads, back = np.unique(places[opening], return_inverse=True)
        pieces[opening] = self._numbers(words.take(pa.array(heads)), False)[back]
        marks[opening] = 0
        # The mark of a word comes behind it.
        more = marks > 0
        shifts = np.r_[0, np.cumsum(more)]
        pieces = np.repeat(pieces, 1 + more)
        pieces[np.flatnonzero(more) + shifts[1:][more]] = marks[more]
        bounds = bounds + shifts[bounds]
        if len(whole):
            first = self._add(texts.take(pa.array(whole)), False)
            pieces[bounds[whole]] = np.arange(first, first + len(whole))
        pieces = np.insert(pieces, bounds[1:], 0)  # piece 0 is the end id
        lengths = self.lengths[pieces]
        stops = np.cumsum(lengths)
        # 32 bits hold the ids of a batch, which is bounded by bytes; what is largest here is
        # as small as can be.
        at = np.repeat((self.starts[pieces] - (stops - lengths)).astype(np.int32), lengths)
        at += np.arange(len(at), dtype=np.int32)
        ids = self.ids[at]
        ends = stops[bounds[1:] + np.arange(len(bounds) - 1)]
        return ids, np.concatenate([[0], ends])


def regrouped(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with at most so many bytes of text, or with one row."""
    waiting, held = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + most_bytes - held, "right"))
            if stop <= start and not waiting:
                stop = start + 1
            if stop > start:
                waiting.append(batch.slice(start, stop - start))
                held += int(ends[stop - 1] - before)
                start = stop
            if start < batch.num_rows:
                yield pa.concat_batches(waiting)
                waiting, held = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def _encoder(tokenizer_file: str) -> Encoder:
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = Encoder(tokenizer_file)
    return _encoders[tokenizer_file]


def write_tokens(
    documents: DataFrame, path: str, tokenizer_file: str, partitions: int | None = None
) -> None:
    """Encode all ``documents`` and write them under ``path``, replacing what is there."""
    spark = documents.sparkSession
    ship(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash splits an id that very many rows share.
    ordered = (
        documents.select(F.col("doc_id").cast("long"), "text")
        .withColumn("body", F.xxhash64("text"))
        .repartitionByRange(partitions, "doc_id", "body")
        .sortWithinPartitions("doc_id", "body")
        .select("doc_id", F.spark_partition_id().alias("part"), "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(tokenizer_file), 0
        for batch in regrouped(batches, "text", BATCH_BYTES):
            give_back_memory()
            ids, bounds = encoder.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array(bounds[:-1] + before, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                ],
                ["doc_id", "part", "first", "ids"],
            )
            before += len(ids)
        encoder.rest()

    (
        ordered.mapInArrow(encode, SCHEMA)
        .write.mode("overwrite")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored documents; filters on ``doc_id`` reach the stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start in the whole, n_tokens, ids_crc32."""
    ship(spark)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy()
            values = lists.values.to_numpy().astype("<u4", copy=False)
            sums = [
                zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    batch.column("first"),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "part", "first", "n_tokens", "ids_crc32"],
            )

    read = store(
        read_tokens(spark, path).mapInArrow(
            summed, "doc_id long, part int, first long, n_tokens long, ids_crc32 long"
        ),
        "token-digest",
    )
    # One row for each written range.
    parts = read.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    return read.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def write_and_digest(documents: DataFrame, tokenizer_file: str) -> DataFrame:
    """Write to a new folder of the shared area, read it back and return the digest."""
    spark = documents.sparkSession
    path = new_folder(spark, "tokens.orc")
    write_tokens(documents, path, tokenizer_file)
    return token_digest(spark, path)


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return write_and_digest(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
