"""Language of documents from a bidirectional gated recurrent network over bytes.

A text is its UTF-8 bytes, cut into windows of ``WINDOW``. One recurrent layer reads a window
forwards and one backwards; at every byte both states give a probability for each language,
and a document's probabilities are the means over all its bytes, whole text. The languages are
those of the training rows. Training is backpropagation through time in numpy, with every byte
labelled by its document's language, from at most ``PER_LANGUAGE`` documents of each language
and ``WINDOWS`` windows, spread over the text, of each; both bounds are parameters. Rows of
documents are chosen by hash of the id, before any text is read, by a ranking that keeps no
more than that many rows of a language in any task.

The model is a few thousand numbers and goes with the task. Prediction is one pass without a
shuffle over batches of windows of a fixed number, whatever the length of the texts.

Defined results: a null text or one without a letter is ``und`` with score 0, as is everything
when there is nothing to learn from. Null languages are not learned. Rows with one id are
labelled one by one, and in training are chosen together. Of equal probabilities the first name
counts. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import give_back_memory, id_bucket, ship, table

UNKNOWN = "und"
LABEL = "_language_id_label"
FOLDS, HELD_OUT = 3, 1
WINDOW, WINDOWS, PER_LANGUAGE = 64, 6, 256
#: Parts in which candidates for learning are ranked first.
PARTS = 16
STATES, STEPS, BATCH, RATE = 8, 220, 192, 0.02
#: Windows that go through the network together.
TOGETHER = 2048


@dataclass
class Network:
    """Arrays with a leading 2 have the forward and the backward layer."""

    names: list[str]
    inputs: np.ndarray  # 2 x 256 x 3 states: update, reset, candidate
    recur: np.ndarray  # 2 x states x 3 states
    output: np.ndarray  # 2 x states x languages
    offset: np.ndarray  # languages

    def states(self, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """2 x length x windows x states, both in reading order of the text."""
        count, length = windows.shape
        n = self.recur.shape[1]
        both = np.stack([windows.T, windows.T[::-1]])
        state = np.zeros((2, count, n), np.float32)
        out = np.empty((2, length, count, n), np.float32)
        for t in range(length):
            given = np.stack([self.inputs[0][both[0, t]], self.inputs[1][both[1, t]]])
            carried = state @ self.recur
            gates = given[..., : 2 * n] + carried[..., : 2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[..., :n], gates[..., n:]
            fresh = np.tanh(given[..., 2 * n :] + reset * carried[..., 2 * n :])
            if keep is not None:
                keep.append((state, update, reset, fresh, carried[..., 2 * n :]))
            state = fresh + update * (state - fresh)
            out[0, t], out[1, length - 1 - t] = state
        return out

    def chances(self, states: np.ndarray) -> np.ndarray:
        """length x windows x languages: the probabilities at every byte."""
        logits = states[0] @ self.output[0]
        logits += states[1] @ self.output[1]
        logits += self.offset
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits

    def pooled(self, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums of the probabilities over the first ``sizes`` bytes of each window."""
        out = np.empty((len(windows), len(self.names)))
        for at in range(0, len(windows), TOGETHER):
            part = windows[at : at + TOGETHER]
            chances = self.chances(self.states(part))
            inside = np.arange(part.shape[1])[:, None] < sizes[at : at + TOGETHER]
            out[at : at + TOGETHER] = np.einsum("tbc,tb->bc", chances, inside)
        return out

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """The probabilities of every text; 0 for an empty one."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        counts = -(-lengths // WINDOW)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        sizes = np.minimum(lengths[owner] - place * WINDOW, WINDOW)
        padded = np.zeros((len(owner), WINDOW), np.uint8)
        inside = np.arange(WINDOW) < sizes[:, None]
        padded[inside] = np.frombuffer(b"".join(texts), np.uint8)
        total = np.zeros((len(texts), len(self.names)))
        np.add.at(total, owner, self.pooled(padded, sizes))
        return total / np.maximum(lengths, 1)[:, None]


def fit(
    windows: np.ndarray,
    sizes: np.ndarray,
    labels: np.ndarray,
    names: list[str],
    states: int = STATES,
    steps: int = STEPS,
    seed: int = 7,
) -> Network:
    """Backpropagation through time with Adam; ``labels`` are places in ``names``."""
    random = np.random.default_rng(seed)
    shapes = [(2, 256, 3 * states), (2, states, 3 * states), (2, states, len(names)), (len(names),)]
    weights = [random.normal(0, s[-2] ** -0.5 if len(s) > 2 and s[1] < 256 else 0.1, s) for s in shapes]
    weights = [w.astype(np.float32) for w in weights]
    weights[3][:] = 0
    net = Network(names, *weights)
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    by_label = [np.flatnonzero(labels == c) for c in range(len(names))]
    for step in range(1, steps + 1):
        # Every language as often as any other.
        rows = np.concatenate([random.choice(r, -(-BATCH // len(names))) for r in by_label])
        grads = _gradients(net, windows[rows], sizes[rows], labels[rows])
        pace = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, s in zip(weights, grads, mean, square, strict=True):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def _gradients(
    net: Network, windows: np.ndarray, sizes: np.ndarray, labels: np.ndarray
) -> list[np.ndarray]:
    count, length = windows.shape
    n = net.recur.shape[1]
    kept: list = []
    states = net.states(windows, kept)
    error = net.chances(states)
    error[:, np.arange(count), labels] -= 1
    error *= (np.arange(length)[:, None] < sizes)[..., None]
    error /= max(1, int(sizes.sum()))
    flat = error.reshape(-1, error.shape[-1])
    d_output = np.stack([states[k].reshape(-1, n).T @ flat for k in (0, 1)])
    d_offset = flat.sum(0)
    reading = np.stack([error @ net.output[0].T, (error @ net.output[1].T)[::-1]])
    d_recur = np.zeros_like(net.recur)
    d_given = np.empty((2, length, count, 3 * n), np.float32)
    back = np.zeros((2, count, n), np.float32)
    for t in range(length - 1, -1, -1):
        before, update, reset, fresh, carried = kept[t]
        back = back + reading[:, t]
        d_fresh = back * (1 - update) * (1 - fresh**2)
        d_update = back * (before - fresh) * update * (1 - update)
        d_reset = d_fresh * carried * reset * (1 - reset)
        d_given[:, t] = np.concatenate([d_update, d_reset, d_fresh], -1)
        d_carried = np.concatenate([d_update, d_reset, d_fresh * reset], -1)
        d_recur += before.transpose(0, 2, 1) @ d_carried
        back = back * update + d_carried @ net.recur.transpose(0, 2, 1)
    d_inputs = np.zeros_like(net.inputs)
    for k, order in ((0, windows.T), (1, windows.T[::-1])):
        place = np.argsort(order, axis=None, kind="stable")
        met, starts = np.unique(order.ravel()[place], return_index=True)
        d_inputs[k, met] = np.add.reduceat(d_given[k].reshape(-1, 3 * n)[place], starts)
    return [d_inputs, d_recur, d_output, d_offset]


def train(documents: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Learn ``lang`` from documents that are not held out; None if there is nothing."""
    ship(documents.sparkSession)
    documents = documents.select("doc_id", "lang", "text")  # other columns may have our names
    # Different ids first, so that one with very many rows takes one place. They are ranked in
    # parts and then over all, so that no task gets candidates of every other one.
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    in_part = W.partitionBy("lang", "part").orderBy(*order)
    first = W.partitionBy("lang").orderBy(*order)
    chosen = (
        documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
        .where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
        .where(F.col("text") != "")
        .select("lang", "doc_id")
        .distinct()
        .withColumn("part", F.pmod(F.hash("doc_id"), F.lit(PARTS)))
        .withColumn("place", F.row_number().over(in_part))
        .where(F.col("place") <= per_language)
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= per_language)
        .select(F.col("doc_id").alias("chosen"), F.col("lang").alias("label"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, label, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                data = (text.as_py() or "").encode()
                places = range(0, len(data), WINDOW)
                picked = np.unique(np.linspace(0, len(places) - 1, WINDOWS).astype(int))
                out += [
                    (doc.as_py(), label.as_py(), data[places[i] : places[i] + WINDOW])
                    for i in picked
                    if len(data)
                ]
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "label", "window"],
            )

    kinds = [pa.int64(), pa.string(), pa.binary()]
    # ``per_language`` rows of each language, so the broadcast is bounded; one text for each of
    # them, the first in order, so the result is too.
    sample = (
        documents.join(
            F.broadcast(chosen), (F.col("doc_id") == F.col("chosen")) & (F.col("lang") == F.col("label"))
        )
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"), "label")
        .agg(F.min("text").alias("text"))
        .mapInArrow(cut, "doc_id long, label string, window binary")
        .orderBy("label", "doc_id", "window")
        .toArrow()
    )
    if not sample.num_rows:
        return None
    texts = sample.column("window").to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    windows = np.zeros((len(texts), WINDOW), np.uint8)
    windows[np.arange(WINDOW) < sizes[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
    names = sorted(set(sample.column("label").to_pylist()))
    labels = np.searchsorted(names, sample.column("label").to_pylist())
    return fit(windows, sizes, labels, names)


def identify(
    documents: DataFrame, net: Network | None, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The rows of ``documents`` with the predicted language and its probability under
    ``names``."""
    predicted, score = names
    ship(documents.sparkSession)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return documents.withColumns({predicted: F.lit(UNKNOWN), score: F.lit(0.0)})

    @F.pandas_udf("place int, score double")
    def label(texts):
        import pandas as pd

        places, scores = [], []
        for at in range(0, len(texts), 200):
            chances = net.predict([(t or "").encode() for t in texts.iloc[at : at + 200]])
            places.append(chances.argmax(1))
            scores.append(chances.max(1).clip(0, 1))
        give_back_memory()
        return pd.DataFrame(
            {"place": np.concatenate([[], *places]).astype("int32"), "score": np.concatenate([[], *scores])}
        )

    # Else the optimizer would run the network once for a filter and once for its result.
    label = label.asNondeterministic()
    languages = F.array(*map(F.lit, net.names))
    found = documents.withColumn(LABEL, label(F.col("text")))
    return found.withColumns(
        {
            predicted: F.when(lettered, F.get(languages, F.col(f"{LABEL}.place"))).otherwise(UNKNOWN),
            score: F.when(lettered, F.col(f"{LABEL}.score")).otherwise(0.0),
        }
    ).drop(LABEL)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = identify(documents.select("doc_id", "text"), train(documents))
    return found.select(
        "doc_id",
        (id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
    )
