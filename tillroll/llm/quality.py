"""Quality of documents, scored by gradient-boosted trees over statistics of the text.

Statistics come from the whole text: shares of kinds of bytes, lengths of words and lines, and
how much of both repeats. Trees are grown on histograms: every statistic is cut into bins at
quantiles, and splits are chosen from sums of gradients for each bin. The model is a few arrays
(a split and a threshold for each inner node, a value for each leaf, trees of one depth), so
a batch goes down all trees in numpy without a branch.

Labels are learned from at most ``TRAINING_ROWS`` labelled documents, the first by hash of
their id; that bound is a parameter. Their statistics are computed on the cluster and only the
numbers come to the driver. Scoring is one pass over the documents without a shuffle.

Defined results: a null or empty text has all statistics 0 and is scored like any other. Rows
with one doc_id are scored one by one; a document with several labels counts as good if any
is; null labels and labels without a document are ignored. Without labels of both kinds all
scores are the share of good labels, or 0.5 without any. Further columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import id_bucket, ship, table

TRAINING_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 64
#: Smallest sum of second derivatives in a leaf, and what is added to it.
LEAST, RIDGE = 2.0, 1.0
SLICE = 500
#: Bytes looked at together, so that a long text takes no more memory than a short one.
CHUNK = 1 << 21

KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c",
    "newline": b"\n",
    "stop": b".,;:",
    "loud": b"!?",
    "pipe": b"|",
    "bracket": b"()[]{}<>'\"`-",
    "symbol": b"#$%&*+/=@\\^_~",
    "high": bytes(range(128, 256)),
}
KIND_OF = np.zeros(256, np.uint8)
for _number, _bytes in enumerate(KINDS.values(), 1):
    KIND_OF[list(_bytes)] = _number
WIDE = len(KINDS) + 1
STATISTICS = [
    "size", *(f"{kind}_share" for kind in KINDS), "other_share", "upper_of_letters",
    "word_length", "words_per_line", "different_words", "different_lines", "stops_per_word",
    "loud_per_word", "symbols_per_word",
]


def kind_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many bytes of each kind every text has; text i is ``data[bounds[i]:bounds[i + 1]]``."""
    counts = np.zeros((len(bounds) - 1, WIDE))
    for start in range(int(bounds[0]), int(bounds[-1]), CHUNK):
        stop = min(start + CHUNK, int(bounds[-1]))
        first = np.searchsorted(bounds, start, "right") - 1
        last = np.searchsorted(bounds, stop, "left")
        inner = np.clip(bounds[first : last + 1], start, stop)
        text = np.repeat(np.arange(last - first), np.diff(inner))
        found = np.bincount(
            text * WIDE + KIND_OF[data[start:stop]], minlength=(last - first) * WIDE
        )
        counts[first:last] += found.reshape(-1, WIDE)
    return counts


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for every text."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    counts = kind_counts(data, bounds)
    words, different, lines, different_lines = np.array(
        [
            (len(w := text.split()), len(set(w)), len(x := text.split(b"\n")), len(set(x)))
            for text in (t.as_buffer().to_pybytes() for t in texts)
        ],
        float,
    ).reshape(-1, 4).T
    size = counts.sum(1)
    some, word = np.maximum(size, 1), np.maximum(words, 1)
    kind = dict(zip(["other", *KINDS], counts.T, strict=True))
    return np.stack(
        [
            np.log1p(size),
            *(kind[k] / some for k in KINDS),
            kind["other"] / some,
            kind["upper"] / np.maximum(kind["upper"] + kind["lower"], 1),
            (size - kind["blank"] - kind["newline"]) / word,
            words / lines,
            different / word,
            different_lines / lines,
            kind["stop"] / word,
            kind["loud"] / word,
            kind["symbol"] / word,
        ],
        1,
    ).astype(np.float32)


@dataclass
class BoostedTrees:
    """Trees of one depth: node i has the children 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        inner = self.feature.shape[1] if self.feature.size else 0
        for feature, threshold, leaf in zip(
            self.feature, self.threshold, self.leaf, strict=True
        ):
            node = np.zeros(len(rows), np.int64)
            while inner and node[:1] < inner and len(node):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
    bins: int = BINS,
) -> BoostedTrees:
    inner, leaves = 2**depth - 1, 2**depth
    share = labels.mean() if len(labels) else 0.5
    nothing = BoostedTrees(
        0.0, np.empty((0, inner), np.int64), np.empty((0, inner)), np.empty((0, leaves))
    )
    if share in (0.0, 1.0) or not len(labels):
        nothing.base = float({0.0: -30.0, 1.0: 30.0}.get(float(share), 0.0))
        return nothing
    edges = [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in rows.T]
    binned = np.stack(
        [np.searchsorted(e, column, "left") for e, column in zip(edges, rows.T, strict=True)], 1
    )
    base = float(np.log(share / (1 - share)))
    total = np.full(len(rows), base)
    made = ([], [], [])
    width = rows.shape[1]
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, curve = chance - labels, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        feature = np.zeros(inner, np.int64)
        threshold = np.full(inner, np.inf)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = node - first
            gains = np.full((many, width, bins), -np.inf)
            for f in range(width):
                place = at * bins + binned[:, f]
                g = np.bincount(place, slope, many * bins).reshape(many, bins).cumsum(1)
                h = np.bincount(place, curve, many * bins).reshape(many, bins).cumsum(1)
                rest_g, rest_h = g[:, -1:] - g, h[:, -1:] - h
                gain = (
                    g**2 / (h + RIDGE)
                    + rest_g**2 / (rest_h + RIDGE)
                    - g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
                )
                gain[(h < LEAST) | (rest_h < LEAST)] = -np.inf
                gain[:, len(edges[f]) :] = -np.inf
                gains[:, f] = gain
            for n in range(many):
                f, b = np.unravel_index(gains[n].argmax(), gains[n].shape)
                if gains[n, f, b] > 1e-9:
                    feature[first + n], threshold[first + n] = f, edges[f][b]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, slope, leaves) / (np.bincount(at, curve, leaves) + RIDGE)
        total += leaf[at]
        for where, what in zip(made, (feature, threshold, leaf), strict=True):
            where.append(what)
    return BoostedTrees(base, *(np.array(x) for x in made))


def train(
    documents: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS
) -> BoostedTrees:
    """Learn ``labels.quality`` from at most ``limit`` documents that are not held out."""
    spark = documents.sparkSession
    ship(spark)
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(F.max((F.col("quality") > 0).cast("int")).alias("good"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(limit)
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for at in range(0, large.num_rows, SLICE):
                batch = large.slice(at, SLICE)
                rows = statistics(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("good"),
                        pa.array(list(rows), pa.list_(pa.float32())),
                    ],
                    ["doc_id", "good", "row"],
                )

    # ``limit`` rows of two numbers at most: small by construction. However many rows share an
    # id, one of them counts, the same in every run, and so ``limit`` rows reach the driver.
    measured = (
        documents.select(F.col("doc_id").cast("long"), "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .select("doc_id", "good", "text")
        .mapInArrow(measure, "doc_id long, good int, row array<float>")
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"), F.min("row").alias("row"))
        .toArrow()
    )
    rows = np.array(measured.column("row").to_pylist(), np.float32).reshape(-1, len(STATISTICS))
    good = measured.column("good").to_numpy().astype(float)
    # Always in one order, whichever task was first.
    order = np.lexsort((*rows.T, measured.column("doc_id").to_numpy()))
    return fit(rows[order], good[order])


def score_quality(
    documents: DataFrame, model: BoostedTrees, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    ship(documents.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for at in range(0, large.num_rows, SLICE):
                batch = large.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(model.score(statistics(batch.column("text"))), pa.float64()),
                    ],
                    ["doc_id", "score"],
                )

    scored = documents.select("doc_id", "text")
    kind = scored.schema["doc_id"].dataType.simpleString()
    return scored.mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id",
        (id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_quality(documents, train(documents, table(spark, sf_dir, "labels")))
