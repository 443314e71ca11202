"""Passages that occur earlier in the corpus are cut out, found by seed and extend.

A repeat is at least ``LENGTH`` words that also stand earlier: in a smaller document, or in the
same one further left. Seeds are runs of ``SEED`` words, thinned by winnowing: of the seeds of
every window of ``LENGTH`` words the one with the smallest hash, the rightmost of equal ones, is
kept as an anchor. Two equal windows keep the same anchor at the same place, so no repeat is
missed, and an anchor stands for the run of windows that chose it.

Documents are joined on their anchors: first the seeds that occur more than once are counted,
then only anchors with such a seed go on. A match is extended both ways as far as the windows of
its anchor reach, at most ``LENGTH - SEED`` words to each side. Anchors whose whole extension
agrees form a class, and all but its first member are repeats at once, whatever the number of
copies. Where a seed has several classes, their first members agree in a part of the extension;
these are extended word by word, that is, compared window by window. Repeats that touch or
overlap are merged into maximal ones.

No step pairs occurrences with each other: each group is reduced to its first member with partial
minima in every task, and what is left is joined back to it, from stored tables, so that adaptive
execution splits the hot seeds, classes and windows.

Defined results: words are runs of other than ASCII white space, compared as they are. A null or
empty text has no words. Rows with one id and one text are one document and fare alike; of rows
with one id and different texts the one with the smaller hash of its text comes first; null is an
id like any other and the smallest. Seeds are 64-bit hashes, classes and windows are told apart
by 128 bits. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tillroll.llm.common import collect_garbage, forget, give_back_memory, ship, store, table

LENGTH = 20
SEED = 5
#: Documents whose words are hashed at once.
SLICE = 256

_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SHIFT = np.uint64(32)

ANCHORS = "seed long, span long, doc_id long, body long, first int, last int"
WINDOWS = "w1 long, w2 long, doc_id long, body long, start int"
KEPT = "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<start:int,words:int>>"


def split_words(texts: pa.Array) -> list[list[bytes]]:
    """The UTF-8 words of each text; bytes are split at ASCII white space alone."""
    return [text.split() if text else [] for text in texts.cast(pa.binary()).to_pylist()]


def hash_words(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words one after another, and where each document's begin and end."""
    bounds = np.zeros(len(documents) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, documents), np.int64, len(documents)), out=bounds[1:])
    flat = map(xxh3_64_intdigest, chain.from_iterable(documents))
    return np.fromiter(flat, np.uint64, int(bounds[-1])), bounds


def _chain(hashes: np.ndarray, starts: np.ndarray, lengths, longest: int, factor) -> np.ndarray:
    """One number for each run of ``lengths`` words from ``starts`` on, which depends on their
    order."""
    mixed = np.full(len(starts), longest, np.uint64)
    for i in range(longest):
        inside = i < lengths
        at = starts if np.isscalar(inside) else np.where(inside, starts, starts[0] - i)
        following = (mixed ^ hashes[at + i]) * factor
        following ^= following >> _SHIFT
        mixed = following if np.isscalar(inside) else np.where(inside, following, mixed)
    return mixed


def find_anchors(
    hashes: np.ndarray, bounds: np.ndarray, length: int = LENGTH, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of all documents: document, first and last window start (places among all
    words), seed hash and hash of the whole extension."""
    none = np.empty(0, np.int64)
    if len(hashes) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(owner[: len(owner) - length + 1] == owner[length - 1 :])
    if not len(starts):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    seeds = _chain(hashes, np.arange(len(hashes) - seed + 1), seed, seed, _FACTORS[0])
    # The smallest seed of each window and its place; of equal ones the rightmost.
    least, place = seeds, np.arange(len(seeds), dtype=np.int64)
    seen, wanted = 1, length - seed + 1
    while seen < wanted:
        step = min(seen, wanted - seen)
        right = least[step:] <= least[:-step]
        least = np.where(right, least[step:], least[:-step])
        place = np.where(right, place[step:], place[:-step])
        seen += step
    chosen = place[starts]
    opens = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    first, last = starts[opens], starts[np.r_[opens[1:] - 1, len(starts) - 1]]
    spans = _chain(
        hashes, first, last - first + length, 2 * length - seed, _FACTORS[1]
    )
    return owner[first], first, last, seeds[chosen[opens]], spans


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)
    give_back_memory()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("body")
    )


def _same(other_id: str, other_body: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col("body") == F.col(other_body))


def anchors_of(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            hashes, bounds = hash_words(split_words(batch.column("text")))
            owner, first, last, seeds, spans = find_anchors(hashes, bounds, length, seed)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(seeds),
                    _signed(spans),
                    batch.column("doc_id").take(rows),
                    batch.column("body").take(rows),
                    pa.array((first - bounds[owner]).astype(np.int32)),
                    pa.array((last - bounds[owner]).astype(np.int32)),
                ],
                ["seed", "span", "doc_id", "body", "first", "last"],
            )

    return _documents(documents).mapInArrow(found, ANCHORS)


def _repeated_anchors(documents: DataFrame, length: int, seed: int) -> DataFrame:
    """The anchors whose seed occurs more than once."""
    anchors = anchors_of(documents, length, seed)
    repeated = store(
        anchors.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"),
        "repeated-seeds",
    )
    live = store(anchors.join(repeated, "seed"), "live-anchors")
    forget(documents.sparkSession, repeated)
    return live


def _windows_of(documents: DataFrame, extended: DataFrame, length: int) -> DataFrame:
    """A row for each window of ``extended``: spans of window starts, one row for each document."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            hashes, bounds = hash_words(split_words(batch.column("text")))
            starts, rows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for row, spans in enumerate(batch.column("spans").to_pylist()):
                for span in spans:
                    places = np.arange(span["first"], span["last"] + 1)
                    starts.append(places + bounds[row])
                    rows.append(np.full(len(places), row))
            starts, rows = np.concatenate(starts), np.concatenate(rows)
            keys = [_chain(hashes, starts, length, length, f) for f in _FACTORS]
            yield pa.RecordBatch.from_arrays(
                [
                    *map(_signed, keys),
                    batch.column("doc_id").take(pa.array(rows)),
                    batch.column("body").take(pa.array(rows)),
                    pa.array((starts - bounds[rows]).astype(np.int32)),
                ],
                ["w1", "w2", "doc_id", "body", "start"],
            )

    spans = extended.groupBy(
        F.col("doc_id").alias("in_doc"), F.col("body").alias("in_body")
    ).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = _documents(documents).join(spans, _same("in_doc", "in_body"))
    return joined.select("doc_id", "body", "text", "spans").mapInArrow(hashed, WINDOWS)


def find_repeats(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, body (hash of the text), and ``first``, ``last``: starts of windows that occur
    earlier. Rows may overlap."""
    spark = documents.sparkSession
    live = _repeated_anchors(documents, length, seed)
    collect_garbage(spark)
    place = F.struct("doc_id", "body", "first")
    classes = store(
        live.groupBy("seed", "span").agg(
            F.min(F.struct("doc_id", "body", "first", "last")).alias("head"),
            F.count(F.lit(1)).alias("members"),
        ),
        "classes",
    )
    # All members of a class but the first are repeats as a whole.
    heads = classes.where("members > 1").select(
        "seed", "span", F.struct("head.doc_id", "head.body", "head.first").alias("head")
    )
    copies = live.join(heads, ["seed", "span"]).where(~place.eqNullSafe(F.col("head")))
    whole = store(copies.select("doc_id", "body", "first", "last"), "whole-copies")
    # The first members of the classes of one seed share some of their windows.
    several = classes.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    extended = store(
        classes.join(several.select("seed"), "seed").select("head.*"), "extended"
    )
    forget(spark, live, classes)
    windows = store(_windows_of(documents, extended, length), "windows")
    forget(spark, extended)
    collect_garbage(spark)
    at = F.struct("doc_id", "body", "start")
    earliest = (
        windows.groupBy("w1", "w2")
        .agg(F.min(at).alias("head"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    single = (
        windows.join(earliest, ["w1", "w2"])
        .where(~at.eqNullSafe(F.col("head")))
        .select("doc_id", "body", F.col("start").alias("first"), F.col("start").alias("last"))
    )
    repeats = store(whole.unionByName(single), "repeats")
    forget(spark, whole, windows)
    collect_garbage(spark)
    return repeats


def cut_words(
    words: list[bytes], spans: list[dict] | None, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words stay, and start and length of the maximal repeats that go."""
    steps = np.zeros(len(words) + 1, np.int64)
    for span in spans or ():
        steps[span["first"]] += 1
        steps[span["last"] + length] -= 1
    gone = np.cumsum(steps)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    return ~gone, edges[::2], edges[1::2] - edges[::2]


def drop_repeats(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, the words that stay joined by blanks, as ``kept``,
    and the maximal repeats that went, as ``repeats``."""
    spark = documents.sparkSession
    ship(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = split_words(batch.column("text"))
            out = {name: [] for name in ("n_words", "n_removed", "kept", "repeats")}
            for words, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                stays, starts, lengths = cut_words(words, spans, length)
                left = words if stays.all() else [words[i] for i in np.flatnonzero(stays)]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(left))
                out["kept"].append(b" ".join(left).decode())
                out["repeats"].append(
                    [
                        {"start": a, "words": n}
                        for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)
                    ]
                )
            kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(out["n_words"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()),
                    pa.array(out["kept"], pa.string()),
                    pa.array(out["repeats"], kind),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "repeats"],
            )

    # One row for each document with repeats; a run of starts may be in several rows.
    spans = (
        find_repeats(documents, length, seed)
        .groupBy(F.col("doc_id").alias("in_doc"), F.col("body").alias("in_body"))
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    )
    joined = _documents(documents).join(spans, _same("in_doc", "in_body"), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(cut, KEPT)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = drop_repeats(table(spark, sf_dir, "documents"))
    return result.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


OP12_SQL = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - {LENGTH - 2})) AS start FROM docs),
windows AS (
  SELECT doc_id, start,
         array_to_string(list_slice(words, start, start + {LENGTH - 1}), ' ') AS run FROM starts),
earlier AS (
  SELECT doc_id, start,
         row_number() OVER (PARTITION BY run ORDER BY doc_id, start) > 1 AS again FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + {LENGTH})) AS place
  FROM earlier WHERE again),
placed AS (
  SELECT doc_id, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM docs),
left_over AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.place) FILTER (WHERE g.place IS NULL) AS kept,
         count(g.place) AS removed
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN left_over l ON d.doc_id = l.doc_id
"""
