"""Texts scored by a hierarchical Pitman-Yor model over words and their contexts.

Every context is a restaurant. A word's context is the whole word before it, or the start of the
text, however many there are. All context restaurants share one parent, the restaurant of single
words, which has each word at one table of its own, as its base is spread over endlessly many
words. A word seen c times in a context sits at t of its tables there; each table is a customer of
the parent. The chance of a word is its share in the context, less a discount for each table, plus
what the discounts free times the chance that the parent gives. In a context that was not seen, it
is the parent's. Unknown words are one class, whose chance in the parent is what a new word has
there.

Seating is sampled by Gibbs: in each sweep the customers of every word in every context sit
down anew, one after the other, with the chances of the Chinese restaurant process given all
other tables; from the ``SINGLE``th on in groups of a sixteenth of those before them, by the
chance at the middle of the group. After ``BURN`` sweeps ``SAMPLES`` seatings are kept, and a
word's chance is the mean over them.

On Spark the cells, which are the different pairs of context and word, are dealt out by the hash of
the word, those of a hot word by the hash of the pair; which words are hot is guessed from a part
of the documents and decides only where cells lie. Counts are merged in each slice of documents
first. What concerns a word as a whole, its customers and tables as a context and as a dish of
the parent, lies where the hash of the word says. Before each sweep the buckets send the sums of
their tables there and get the totals of all buckets back; many buckets write by way of crews. A
single customer has one table, so only cells with several take part. Each cell draws by a key of
its own, so neither seating nor scores depend on the number of buckets.

Documents are scored in rounds, and in each by slices: a slice asks for its words and its cells,
and sums up by document what comes back. After a round only the scores stay.

Defined results: words are compared with A-Z lower-cased; a null or empty text is its end only.
Every row is scored by itself; a row without id counts as one with an empty id for the split.
Without training rows all words are unknown and equally likely to come or not. Further columns
are ignored. An empty table gives no rows. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tillroll.llm.common import (
    collect_garbage,
    forget,
    give_back_memory,
    giving_back,
    id_bucket,
    ship,
    store,
    table,
)
from tillroll.llm.shingles import by_bucket

FOLDS, HELD_OUT = 7, 2
DISCOUNT, STRENGTH = 0.8, 50.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 100.0
BURN, SAMPLES = 2, 3
SINGLE = 256
SLICE = 2000
#: Documents are scored in so many rounds, each a part of them by hash.
ROUNDS = 3
BUCKET_TOKENS = 1_000_000
#: Up to so many buckets write to each other. More go by crews, each of as many buckets as there are
#: crews, so that notes do not grow with the square of the buckets.
DIRECT = 128
#: One of so many documents tells which words are hot: those with more than a quarter of a bucket.
HOT_PART = 64
END = xxh3_64_intdigest(b"", seed=1)


def tokens(
    texts: pa.Array | pa.ChunkedArray | list[str | None],
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, and for every token: place of its word, document, place of the word before."""
    if isinstance(texts, list):
        texts = pa.array(texts, pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, document = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    given = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves empty words
    words, document = words.filter(given), document[given.to_numpy(zero_copy_only=False)]
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    coded = words.dictionary_encode()
    known = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    hashes = np.empty(len(known) + 1, np.uint64)
    hashes[0] = END
    hashes[1:] = np.fromiter(map(xxh3_64_intdigest, known), np.uint64, len(known))
    lengths = np.bincount(document, minlength=len(texts)) + 1
    place = np.zeros(len(document) + len(texts), np.int64)
    # The end of each document before moves a word by one.
    place[np.arange(len(document)) + document] = coded.indices.to_numpy().astype(np.int64) + 1
    before = np.r_[0, place[:-1]] if len(place) else place
    return hashes, place, np.repeat(np.arange(len(texts)), lengths), before


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs; the first byte is the width."""
    largest = int(numbers.max()) if numbers.size else 0
    width = next(n for n in (1, 2, 4, 8) if largest < 1 << 8 * n)
    return bytes([width]) + numbers.astype(f"u{width}").tobytes()


def _narrow(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"u{packed[0]}", offset=1)


def _unpack(packed: bytes) -> np.ndarray:
    return _narrow(packed).astype(np.int64)


def _hashes(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint64)


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int32)


def _mixed(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """A hash of each pair."""
    x = words * np.uint64(0x9E3779B97F4A7C15) ^ contexts
    for factor in (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def _cell_bucket(
    words: np.ndarray, contexts: np.ndarray, hot: np.ndarray, buckets: int
) -> np.ndarray:
    by = words.copy()
    spread = np.isin(words, hot)
    by[spread] = _mixed(words[spread], contexts[spread])
    return _bucket_of(by, buckets)


def _different(numbers: np.ndarray) -> np.ndarray:
    """Different numbers in ascending order, by sorting: ``np.unique`` hashes them, which takes
    thirty times as long on a slice."""
    numbers = np.sort(numbers)
    return numbers[np.r_[True, numbers[1:] != numbers[:-1]]] if len(numbers) else numbers


def _numbered(keys: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` with the inverse, for numbers up to ``largest``: each is sorted with its
    place behind it, if both are 63 bits at most."""
    bits = len(keys).bit_length()
    if largest.bit_length() + bits > 63 or not len(keys):
        return np.unique(keys, return_inverse=True)
    both = np.sort(keys << bits | np.arange(len(keys)))
    at, both = both & ((1 << bits) - 1), both >> bits
    new = np.r_[True, both[1:] != both[:-1]]
    back = np.empty(len(keys), np.int64)
    back[at] = np.cumsum(new) - 1
    return both[new], back


def _by_pair(rank: np.ndarray, contexts: np.ndarray, ranks: int) -> np.ndarray:
    """The order by rank and context.

    One sort by a number of the rank and the leading bits of the context; where these do not tell
    contexts of a rank apart, by both in full."""
    bits = max(1, ranks.bit_length())
    keys = rank.astype(np.uint64) << np.uint64(64 - bits) | contexts >> np.uint64(bits)
    order = np.argsort(keys)
    keys, given = keys[order], contexts[order]
    if ((keys[1:] == keys[:-1]) & (given[1:] != given[:-1])).any():
        return np.lexsort((contexts, rank))
    return order


def _by_owner(names: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Different names in order of owner and hash, and where each given one is among them."""
    own, back = np.unique(names, return_inverse=True)
    order = np.lexsort((own, own % np.uint64(buckets)))
    rank = np.empty(len(own), np.int64)
    rank[order] = np.arange(len(own))
    return own[order], rank[back]


def _runs(sorted_buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket with where it lies."""
    starts = np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1]])
    if len(sorted_buckets):
        for a, b in zip(starts, np.r_[starts[1:], len(sorted_buckets)], strict=True):
            yield int(sorted_buckets[a]), slice(a, b)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and which are there at all."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)],
        [n for n, _ in fields],
    )


class Draws:
    """Random numbers by key, so that what a cell draws does not depend on the cells beside it."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.step = 0
        self.own: list[np.random.Generator] = []

    def random(self, active: int) -> np.ndarray:
        self.step += 1
        drawn = _mixed(self.keys[:active], np.full(active, self.step, np.uint64))
        return (drawn >> np.uint64(11)) * 2.0**-53

    def binomial(self, size: np.ndarray, chance: np.ndarray) -> np.ndarray:
        if not self.own:  # the first that get here are the most
            self.own = [np.random.Generator(np.random.Philox(int(k))) for k in self.keys[: len(size)]]
        drawn = zip(self.own, size.tolist(), chance.tolist(), strict=False)
        return np.fromiter((g.binomial(n, p) for g, n, p in drawn), np.int64, len(size))


def tables_of(
    counts: np.ndarray,
    weight: np.ndarray,
    discount: float,
    random: np.random.Generator | None = None,
    keys: np.ndarray | None = None,
) -> np.ndarray:
    """Tables that ``counts`` customers of a dish take, one after the other.

    ``weight`` is that of a new table; an old one weighs its customers less the discount. Drawn
    from ``random``, or for each cell by its own one of ``keys``."""
    order = np.argsort(-counts, kind="stable")
    random = Draws(keys[order]) if keys is not None else random
    left, a = counts[order], weight[order]
    taken = np.ones(len(counts))
    seated = 1
    active = len(left)
    while active:
        group = 1 if seated < SINGLE else seated // 16
        active = int(np.searchsorted(-left, -seated, "left"))  # those with more customers
        if not active:
            break
        t, w = taken[:active], a[:active]
        # Who has fewer customers left than the group has ends within it.
        size = np.minimum(left[:active] - seated, group)
        middle = seated + (size - 1) / 2
        chance = w / (w + middle - discount * t)
        if group == 1:
            t += random.random(active) < chance
        else:
            t += random.binomial(size, np.clip(chance, 0, 1))
        seated += group
    out = np.empty(len(counts))
    out[order] = taken
    return out


def crew_size(buckets: int) -> int:
    """How many buckets are a crew."""
    return 1 if buckets <= DIRECT else math.isqrt(buckets - 1) + 1


def _to_crews(
    source: int, kind: str, buckets: int, size: int, lengths: np.ndarray, names: np.ndarray, *numbers
) -> list[tuple]:
    """A note for each crew of owners, of arrays in order of owner with ``lengths`` for each.

    It goes to the owner itself if crews are single buckets, else to the relay that stands between
    the crew of the source and that of the owners."""
    crews, mine = -(-buckets // size), source // size
    ends = np.r_[0, np.cumsum(lengths)]
    rows = []
    for crew in range(crews):
        first, last = crew * size, min(crew * size + size, buckets)
        run = slice(ends[first], ends[last])
        if run.start == run.stop:
            continue
        packed = [_pack(x[run]) for x in numbers]
        given = [names[run].tobytes(), *packed, *[None] * (4 - len(packed))]
        to = crew if size == 1 else crew * crews + mine
        rows.append(_note(to, kind, source, *given, _pack(lengths[first:last])))
    return rows


def _relay(buckets: int, size: int):
    """What a crew has for another crew: notes by sender become notes by recipient."""
    crews = -(-buckets // size)

    def turn(block: pa.Table) -> pa.Table:
        rows = sorted(block.to_pylist(), key=lambda r: r["source"])
        crew, senders = divmod(rows[0]["bucket"], crews)
        # By sender and recipient.
        lengths = np.array([_unpack(r["f"]) for r in rows])
        ends = np.c_[np.zeros(len(rows), np.int64), lengths.cumsum(1)]
        at = [r["source"] % size for r in rows]

        def parts(name: str, read) -> list[np.ndarray]:
            whole = [read(r[name]) for r in rows]
            return [
                np.concatenate([x[e[n] : e[n + 1]] for x, e in zip(whole, ends, strict=True)])
                for n in range(lengths.shape[1])
            ]

        names = parts("a", _hashes) if rows[0]["a"] else None
        numbers = [parts(n, _narrow) for n in "bcde" if rows[0][n] is not None]
        out = []
        for n in range(lengths.shape[1]):
            if not lengths[:, n].any():
                continue
            of = np.zeros(min(size, buckets - senders * size), np.int64)
            of[at] = lengths[:, n]
            packed = [_pack(x[n]) for x in numbers]
            given = [b"" if names is None else names[n].tobytes(), *packed, *[None] * (4 - len(packed))]
            out.append(_note(crew * size + n, rows[0]["kind"], senders, *given, _pack(of)))
        return _notes(out)

    return turn


#: One schema for all that goes between buckets: who gets it, what it is, from which bucket or of
#: which slice, and up to six arrays.
NOTE_FIELDS = [("bucket", pa.int32()), ("kind", pa.string()), ("source", pa.int64())] + [
    (name, pa.binary()) for name in "abcdef"
]
NOTE_SCHEMA = "bucket int, kind string, source long, " + ", ".join(f"{n} binary" for n in "abcdef")
MODEL_SCHEMA = (
    "bucket int, names binary, customers binary, tables binary, words binary, contexts binary, "
    "counts binary, seated binary, totals array<double>"
)


def _note(bucket: int, kind: str, source: int, *arrays: bytes | None) -> tuple:
    return (bucket, kind, source, *arrays, *[None] * (6 - len(arrays)))


def _notes(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, NOTE_FIELDS)])


def _of_kind(block: pa.Table, kind: str) -> list[dict]:
    """Rows of a kind in one order."""
    rows = block.filter(pc.equal(block.column("kind"), kind)).to_pylist()
    return sorted(rows, key=lambda r: r["source"])


def hot_words(learned: DataFrame, buckets: int) -> np.ndarray:
    """Hashes of words with more than a quarter of a bucket's share: at most 4 for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, place, _, _ = tokens(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(np.bincount(place, minlength=len(hashes)))],
                ["word", "number"],
            )

    part = learned.where(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_PART)) == 0).select("text")
    counts = part.mapInArrow(count, "word long, number long").groupBy("word").agg(
        F.sum("number").alias("number")
    )
    counts = store(counts, "word-counts")
    every = counts.agg(F.sum("number")).first()[0] or 0
    found = counts.where(F.col("number") * 4 * buckets > every).select("word").collect()
    forget(counts.sparkSession, counts)
    return np.sort(np.array([r["word"] for r in found], np.int64).view(np.uint64))


def train(documents: DataFrame, buckets: int, seed: int = 11) -> DataFrame:
    """A row for each bucket: its words with their totals, its cells, and sums over its words."""
    learned = documents.where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
    return _train(learned, buckets, hot_words(learned, buckets), seed)


def _train(learned: DataFrame, buckets: int, hot: np.ndarray, seed: int) -> DataFrame:
    spark, size = learned.sparkSession, crew_size(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for at in range(0, large.num_rows, SLICE):
                give_back_memory()
                hashes, place, _, before = tokens(large.column("text").slice(at, SLICE))
                keys, counts = np.unique(place * len(hashes) + before, return_counts=True)
                words, contexts = keys // len(hashes), hashes[keys % len(hashes)]
                rows = []
                for bucket, (own, other, number) in by_bucket(
                    _cell_bucket(hashes[words], contexts, hot, buckets), words, contexts, counts
                ):
                    own, cells = np.unique(own, return_counts=True)
                    arrays = hashes[own].tobytes(), _pack(cells), other.tobytes(), _pack(number)
                    rows.append(_note(bucket, "counts", 0, *arrays))
                yield _batch(rows, NOTE_FIELDS)

    def of_owners(names: np.ndarray) -> np.ndarray:
        """How many of the names each bucket owns."""
        return np.bincount(_bucket_of(names, buckets), minlength=buckets)

    def merge(block: pa.Table) -> pa.Table:
        bucket = block.column("bucket")[0].as_py()
        rows = block.to_pylist()
        words = np.concatenate([_hashes(r["a"]) for r in rows])
        cells, counts = (np.concatenate([_unpack(r[n]) for r in rows]) for n in "bd")
        contexts = np.concatenate([_hashes(r["c"]) for r in rows])
        known = _different(words)
        rank = np.repeat(np.searchsorted(known, words), cells)
        order = _by_pair(rank, contexts, len(known))
        rank, contexts = rank[order], contexts[order]
        starts = np.flatnonzero(
            np.r_[True, (rank[1:] != rank[:-1]) | (contexts[1:] != contexts[:-1])]
        )
        words, contexts = known[rank[starts]], contexts[starts]
        counts = np.add.reduceat(counts[order], starts)
        out = [_note(bucket, "cells", 0, words.tobytes(), contexts.tobytes(), _pack(counts))]
        # Only cells with several customers move, here by falling number; each begins with one table.
        moves = np.flatnonzero(counts > 1)
        moves = moves[np.argsort(-counts[moves], kind="stable")]
        names, place = _by_owner(np.r_[words[moves], contexts[moves]], buckets)
        moving = [_pack(place[: len(moves)]), _pack(place[len(moves) :]), _pack(counts[moves])]
        tables = np.ones(len(moves), np.int64)
        out.append(_note(bucket, "moving", 0, names.tobytes(), *moving, _pack(tables)))
        names, place = _by_owner(np.r_[words, contexts], buckets)
        as_word, as_context = place[: len(words)], place[len(words) :]
        sums = [
            np.bincount(p, w, len(names))
            for w in (counts, None)
            for p in (as_word, as_context)
        ]
        out += _to_crews(bucket, "whole", buckets, size, of_owners(names), names, *sums)
        return _notes(out)

    def own(block: pa.Table) -> pa.Table:
        """Names of an owner: customers as word and context, cells as word and context."""
        rows = block.to_pylist()
        names, back = np.unique(np.concatenate([_hashes(r["a"]) for r in rows]), return_inverse=True)
        sums = [
            _pack(np.bincount(back, np.concatenate([_unpack(r[n]) for r in rows]), len(names)))
            for n in "bcde"
        ]
        return _notes([_note(rows[0]["bucket"], "owned", 0, names.tobytes(), *sums)])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tables beyond the first of the cells that move, summed by name, to the owners."""
        for batch in batches:
            for row in batch.to_pylist():
                names, (as_word, as_context) = _hashes(row["a"]), (_unpack(row[n]) for n in "bc")
                beyond = _unpack(row["e"]) - 1
                sums = [np.bincount(p, beyond, len(names)) for p in (as_word, as_context)]
                out = _to_crews(row["bucket"], "report", buckets, size, of_owners(names), names, *sums)
                yield _batch(out, NOTE_FIELDS)

    def total(block: pa.Table) -> pa.Table:
        """Tables of an owner's names, for itself and for each that reported some."""
        [owned] = _of_kind(block, "owned")
        names, as_word, as_context = _hashes(owned["a"]), _unpack(owned["d"]), _unpack(owned["e"])
        reports = [(r, np.searchsorted(names, _hashes(r["a"]))) for r in _of_kind(block, "report")]
        for r, at in reports:
            as_word += np.bincount(at, _unpack(r["b"]), len(names)).astype(np.int64)
            as_context += np.bincount(at, _unpack(r["c"]), len(names)).astype(np.int64)
        me = owned["bucket"]
        every = _pack(as_word.sum(keepdims=True))
        out = [_note(me, "tables", me, _pack(as_word), _pack(as_context), every)]
        for r, at in reports:
            # Back by the way it came: ``f`` has how much of it is for each of the crew.
            to = r["source"] if size == 1 else r["source"] * -(-buckets // size) + me // size
            answer = _pack(as_word[at]), _pack(as_context[at])
            out.append(_note(to, "answer", me, b"", *answer, None, None, r["f"]))
        return _notes(out)

    def seat(sweep: int, every: int):
        def of_bucket(block: pa.Table) -> pa.Table:
            [row] = _of_kind(block, "moving")
            answers = _of_kind(block, "answer")
            names, (words, contexts, counts) = _hashes(row["a"]), (_unpack(row[n]) for n in "bcd")
            tables = np.ones(0)
            if len(words):
                # Answers come in order of owner, as the names.
                in_parent, in_context = (np.concatenate([_unpack(r[n]) for r in answers]) for n in "bc")
                parent = (in_parent[words] - ROOT_DISCOUNT) / (ROOT_STRENGTH + every)
                weight = (STRENGTH + DISCOUNT * in_context[contexts]) * parent
                run = np.full(len(words), seed * (BURN + SAMPLES) + sweep, np.uint64)
                keys = _mixed(_mixed(names[words], names[contexts]), run)
                tables = tables_of(counts, weight, DISCOUNT, keys=keys)
            same = [row[n] for n in "abcd"]
            return _notes([_note(row["bucket"], "moving", 0, *same, _pack(tables))])

        return of_bucket

    def of(frame: DataFrame, kind: str) -> DataFrame:
        return frame.where(F.col("kind") == kind)

    def delivered(notes: DataFrame) -> DataFrame:
        if size == 1:
            return notes
        return notes.groupBy("bucket").applyInArrow(giving_back(_relay(buckets, size)), NOTE_SCHEMA)

    counted = learned.select("text").mapInArrow(count, NOTE_SCHEMA)
    merged = store(counted.groupBy("bucket").applyInArrow(giving_back(merge), NOTE_SCHEMA), "cells")
    owned = store(delivered(of(merged, "whole")).groupBy("bucket").applyInArrow(giving_back(own), NOTE_SCHEMA), "owned")
    moving, stored = of(merged, "moving"), []
    kept = []
    for sweep in range(BURN + SAMPLES + 1):
        reports = delivered(moving.mapInArrow(report, NOTE_SCHEMA)).unionByName(owned)
        totals = store(reports.groupBy("bucket").applyInArrow(giving_back(total), NOTE_SCHEMA), "totals")
        if sweep > BURN:  # of a seating that is kept, by its place, only the numbers of tables
            number = F.lit(sweep - BURN - 1).cast("long")
            nothing = {name: F.lit(None).cast("binary") for name in "abcd"}
            numbers = moving.withColumns(nothing).withColumn("source", number)
            kept.append(
                store(
                    of(totals, "tables").withColumn("source", number).unionByName(numbers),
                    "sample",
                )
            )
        following = []
        if sweep < BURN + SAMPLES:
            # One row for each owner.
            every = sum(int(_unpack(r["c"])[0]) for r in of(totals, "tables").select("c").collect())
            given = moving.unionByName(delivered(of(totals, "answer"))).groupBy("bucket")
            moving = store(given.applyInArrow(giving_back(seat(sweep, every)), NOTE_SCHEMA), "seating")
            following = [moving]
        # What the sweep has read is of no more use.
        forget(spark, totals, *stored)
        stored = following
        collect_garbage(spark)

    def assemble(block: pa.Table) -> pa.Table:
        bucket = block.column("bucket")[0].as_py()
        cells, owns = _of_kind(block, "cells"), _of_kind(block, "owned")
        names = customers = tables = b""
        totals = np.zeros(SAMPLES + 2)
        if owns:
            names = owns[0]["a"]
            as_word, as_context = _unpack(owns[0]["b"]), _unpack(owns[0]["c"])
            samples = [(_unpack(r["a"]), _unpack(r["b"])) for r in _of_kind(block, "tables")]
            customers = _pack(np.r_[as_word, as_context])
            tables = _pack(np.r_[*(w for w, _ in samples), *(c for _, c in samples)])
            totals = np.array([*(w.sum() for w, _ in samples), (as_word > 0).sum(), as_word.sum()])
        words = contexts = counts = seated = b""
        if cells:
            words, contexts, counts = (cells[0][n] for n in "abc")
            every = np.ones((SAMPLES, len(_hashes(words))), np.int64)
            moves = np.flatnonzero(_unpack(counts) > 1)
            moves = moves[np.argsort(-_unpack(counts)[moves], kind="stable")]
            for row in _of_kind(block, "moving"):
                every[row["source"], moves] = _unpack(row["e"])
            seated = _pack(every)
        row = (bucket, names, customers, tables, words, contexts, counts, seated)
        return pa.table(
            {
                n: pa.array([v], pa.int32() if n == "bucket" else pa.binary())
                for n, v in zip(MODEL_FIELDS, row, strict=True)
            }
            | {"totals": pa.array([totals.astype(float).tolist()], pa.list_(pa.float64()))}
        )

    parts = of(merged, "cells").unionByName(owned)
    for part in kept:
        parts = parts.unionByName(part)
    model = store(parts.groupBy("bucket").applyInArrow(giving_back(assemble), MODEL_SCHEMA), "seatings")
    forget(spark, merged, owned, *kept)
    collect_garbage(spark)
    return model


MODEL_FIELDS = ["bucket", "names", "customers", "tables", "words", "contexts", "counts", "seated"]


def chance(
    counts: np.ndarray, seated: np.ndarray, customers: np.ndarray, tables: np.ndarray,
    above: np.ndarray,
) -> np.ndarray:
    """Of words in contexts that have ``customers`` at ``tables``, by sample; ``above`` is that
    in the parent."""
    own = np.where(counts > 0, counts - DISCOUNT * seated, 0)
    return (own + (STRENGTH + DISCOUNT * tables) * above) / (STRENGTH + customers)


def chance_above(counts: np.ndarray, in_parent: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """In the parent, of words with ``counts`` customers, by sample; of 0 that of any new word."""
    every = (ROOT_STRENGTH + totals[:SAMPLES])[:, None]
    new = (ROOT_STRENGTH + ROOT_DISCOUNT * totals[-2]) / every
    return np.where(counts > 0, (in_parent - ROOT_DISCOUNT) / every, new)


class Chances:
    """The model of one bucket with the totals of all."""

    def __init__(self, row: dict | None, totals: np.ndarray):
        self.totals = totals
        row = row or {}
        self.names = _hashes(row.get("names") or b"")
        self.customers = _unpack(row.get("customers") or b"\1").reshape(2, -1)
        self.tables = _unpack(row.get("tables") or b"\1").reshape(2, SAMPLES, -1)
        self.words = self.names[self.customers[0] > 0]
        self.cell_words = _hashes(row.get("words") or b"")
        self.cell_contexts = _hashes(row.get("contexts") or b"")
        self.counts = _narrow(row.get("counts") or b"\1")
        self.seated = _narrow(row.get("seated") or b"\1").reshape(SAMPLES, -1)
        # Sorted by a hash of the pair, to find cells at once; pairs themselves are compared.
        mixed = _mixed(self.cell_words, self.cell_contexts)
        self.order = np.argsort(mixed)
        self.mixed = mixed[self.order]

    def of_names(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """2 x names customers and 2 x SAMPLES x names tables, as word and as context."""
        at, met = _find(self.names, names)
        customers = np.zeros((2, len(names)), np.int64)
        tables = np.zeros((2, SAMPLES, len(names)), np.int64)
        customers[:, met] = self.customers[:, at[met]]
        tables[:, :, met] = self.tables[:, :, at[met]]
        return customers, tables

    def of_cells(self, words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts, and SAMPLES x cells tables."""
        wanted = _mixed(words, contexts)
        order = np.argsort(wanted)  # in order they are found sooner
        at, met = np.empty(len(wanted), np.int64), np.empty(len(wanted), bool)
        at[order], met[order] = _find(self.mixed, wanted[order])
        if met.any():
            at = self.order[at]
            met &= (self.cell_words[at] == words) & (self.cell_contexts[at] == contexts)
        counts = np.zeros(len(words), self.counts.dtype)
        seated = np.zeros((SAMPLES, len(words)), self.seated.dtype)
        counts[met] = self.counts[at[met]]
        seated[:, met] = self.seated[:, at[met]]
        return counts, seated

    def score(self, words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each word was seen, and the log10 of its chance in the context, as far as
        this bucket knows both."""
        (seen, _), (in_parent, _) = self.of_names(words)
        (_, customers), (_, tables) = self.of_names(contexts.astype(np.uint64))
        counts, seated = self.of_cells(words, contexts.astype(np.uint64))
        above = chance_above(seen, in_parent, self.totals)
        return seen, np.log10(chance(counts, seated, customers, tables, above).mean(0))


def score_documents(documents: DataFrame, seed: int = 11) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and the
    perplexity, ``10 ^ (-score / n_tokens)``."""
    spark = documents.sparkSession
    ship(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = documents.select(
        F.col("doc_id").cast("long"),
        "text",
        (id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held"),
    )
    characters = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(partitions, math.ceil(characters / 5 / BUCKET_TOKENS))
    learned = read.where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
    hot = hot_words(learned, buckets)
    model = _train(learned, buckets, hot, seed)
    totals = np.zeros(SAMPLES + 2)
    # One row for each place.
    for row in (
        model.select(F.posexplode("totals").alias("place", "value"))
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
        .collect()
    ):
        totals[row["place"]] = row["value"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A slice asks owners for names and buckets for cells, in order of both, and gives its
        own head: documents, the place of each token's name, and the bucket of each cell."""
        task, number = TaskContext.get().partitionId(), 0
        for large in batches:
            for at in range(0, large.num_rows, SLICE):
                give_back_memory()
                batch = large.slice(at, SLICE)
                source = task * (1 << 32) + number
                number += 1
                hashes, place, document, before = tokens(batch.column("text"))
                names, rank = _by_owner(hashes, buckets)
                place, before, end = rank[place], rank[before], rank[:1]
                rows = [
                    _note(owner, "names", source, names[run].tobytes())
                    for owner, run in _runs(_bucket_of(names, buckets))
                ]
                keys = _different(place * len(names) + before)
                words, contexts = keys // len(names), keys % len(names)
                of = _cell_bucket(names[words], names[contexts], hot, buckets)
                order = np.argsort(of, kind="stable")
                words, contexts = words[order], contexts[order]
                for bucket, run in _runs(of[order]):
                    own, cells = np.unique(words[run], return_counts=True)
                    arrays = names[own].tobytes(), _pack(cells), names[contexts[run]].tobytes()
                    rows.append(_note(bucket, "cells", source, *arrays))
                ids = batch.column("doc_id")
                absent = ids.is_null().to_numpy(zero_copy_only=False)
                flags = batch.column("held").to_numpy(zero_copy_only=False) + 2 * absent
                rows.append(
                    _note(
                        source % buckets,
                        "head",
                        source,
                        ids.fill_null(0).to_numpy().tobytes(),
                        flags.astype(np.uint8).tobytes(),
                        _pack(np.bincount(document, minlength=batch.num_rows)),
                        _pack(place),
                        _pack(of),
                        _pack(end),
                    )
                )
                yield _batch(rows, NOTE_FIELDS)

    def answer(block: pa.Table) -> pa.Table:
        """What is asked of a bucket, in the order of the questions; heads pass."""
        rows = block.to_pylist()
        models = [r for r in rows if r["kind"] == "model"]
        chances = Chances(models[0] if models else None, totals)
        out = []
        for row in rows:
            if row["kind"] == "names":
                customers, tables = chances.of_names(_hashes(row["a"]))
                arrays = _pack(customers), _pack(tables)
            elif row["kind"] == "cells":
                words = np.repeat(_hashes(row["a"]), _unpack(row["b"]))
                counts, seated = chances.of_cells(words, _hashes(row["c"]))
                arrays = _pack(counts), _pack(seated)
            elif row["kind"] == "head":
                arrays = [row[n] for n in "abcdef"]
            else:
                continue
            out.append(_note(row["bucket"], row["kind"], row["source"], *arrays))
        return _notes(out)

    def gather(block: pa.Table) -> pa.Table:
        rows = sorted(block.to_pylist(), key=lambda r: r["bucket"])
        head = next(r for r in rows if r["kind"] == "head")
        ids = np.frombuffer(head["a"], np.int64)
        flags = np.frombuffer(head["b"], np.uint8)
        lengths, place, of, end = (_unpack(head[n]) for n in "cdef")

        def together(kind: str, name: str, rows_each: int) -> np.ndarray:
            parts = [_unpack(r[name]).reshape(rows_each, -1) for r in rows if r["kind"] == kind]
            return np.concatenate(parts, 1)

        (seen, customers), tables = together("names", "a", 2), together("names", "b", 2 * SAMPLES)
        [counts], seated = together("cells", "a", 1), together("cells", "b", SAMPLES)
        keys = place * len(seen) + np.r_[end, place[:-1]]
        keys, cell = _numbered(keys, len(seen) ** 2)
        words, contexts = keys // len(seen), keys % len(seen)
        # Answers come in order of bucket.
        back = np.empty(len(of), np.int64)
        back[np.argsort(of, kind="stable")] = np.arange(len(of))
        counts, seated = counts[back], seated[:, back]
        above = chance_above(seen, tables[:SAMPLES], totals)
        whole = np.zeros(len(words))
        for n in range(SAMPLES):  # a sample at a time, for less memory
            whole += chance(
                counts, seated[n], customers[contexts], tables[SAMPLES + n][contexts], above[n][words]
            )
        logs = np.log10(whole / SAMPLES)
        bases = np.log10((seen + 1) / (totals[-1] + totals[-2] + 1))
        document = np.repeat(np.arange(len(ids)), lengths)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=flags >= 2),
                "held_out": pa.array(flags % 2 == 1),
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(np.bincount(document, seen[place] > 0, len(ids)).astype(np.int64)),
                "base_score": pa.array(np.bincount(document, bases[place], len(ids))),
                "score": pa.array(np.bincount(document, logs[cell], len(ids))),
            }
        )

    models = model.select(
        "bucket", F.lit("model").alias("kind"), F.lit(None).cast("long").alias("source"),
        *(F.lit(None).cast("binary").alias(n) for n in "abcdef"), *MODEL_FIELDS[1:],
    )

    def score(part: DataFrame) -> DataFrame:
        asked = part.mapInArrow(deal, NOTE_SCHEMA).select(
            "*", *(F.lit(None).cast("binary").alias(n) for n in MODEL_FIELDS[1:])
        )
        parts = asked.unionByName(models).groupBy("bucket").applyInArrow(giving_back(answer), NOTE_SCHEMA)
        found = parts.groupBy("source").applyInArrow(
            giving_back(gather),
            "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
            "score double",
        )
        return store(found, "scores")

    # What a round asked and was answered goes before the next; together these are more than all
    # documents. A document's score does not depend on those beside it.
    place, scored = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)), []
    for number in range(ROUNDS):
        scored.append(score(read.where(place == number)))
        collect_garbage(spark)
    forget(spark, model)
    scored = reduce(DataFrame.unionByName, scored)
    return scored.withColumns(
        {
            "train_tokens": F.lit(int(totals[-1])).cast("long"),
            "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")),
        }
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
