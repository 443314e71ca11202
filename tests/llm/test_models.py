"""What is learned: accuracy on rows that were held out, gradients, and proper chances."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import ODD
from tillroll.llm import language_id, language_model, quality, shingles
from xxhash import xxh3_64_intdigest


def bucket(doc, modulus):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % modulus


# language identification


def test_gradients_are_those_of_the_loss():
    random = np.random.default_rng(1)
    n = 3
    shapes = [(2, 256, 3 * n), (2, n, 3 * n), (2, n, 2), (2,)]
    net = language_id.Network(["a", "b"], *(random.normal(0, 0.5, s).astype(np.float32) for s in shapes))
    windows = random.integers(97, 101, (5, 7)).astype(np.uint8)
    sizes, labels = np.array([7, 3, 1, 5, 7]), np.array([0, 1, 1, 0, 1])

    def loss():
        chances = net.chances(net.states(windows))
        inside = np.arange(7)[:, None] < sizes
        picked = chances[:, np.arange(5), labels]
        return -(np.log(picked.astype(float)) * inside).sum() / sizes.sum()

    found = language_id._gradients(net, windows, sizes, labels)
    for weights, gradient in zip((net.inputs, net.recur, net.output, net.offset), found, strict=True):
        for place in [np.unravel_index(np.abs(gradient).argmax(), gradient.shape)]:
            kept, step = weights[place], 1e-2
            weights[place] = kept + step
            above = loss()
            weights[place] = kept - step
            below = loss()
            weights[place] = kept
            assert gradient[place] == pytest.approx((above - below) / (2 * step), rel=0.05, abs=1e-4)


def test_languages_of_held_out_documents(spark, sf_gate):
    found = language_id.op3_language_id(spark, sf_gate)
    truth = spark.read.parquet(f"{sf_gate}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert all(bucket(r.doc_id, 3) == 1 and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) > 200


def test_odd_languages(spark, odd, none):
    net = language_id.train(odd)
    got = language_id.identify(odd, net).collect()
    assert len(got) == len(ODD)
    for row in got:
        lettered = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not lettered) and 0 <= row.score <= 1
        assert lettered or row.score == 0
    assert language_id.train(none) is None
    assert language_id.identify(none, net).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}


def test_probabilities_against_a_plain_loop():
    """One window, one byte, one state at a time, as the equations of the network have it."""
    random = np.random.default_rng(6)
    n, names = 4, ["a", "b", "c"]
    shapes = [(2, 256, 3 * n), (2, n, 3 * n), (2, n, 3), (3,)]
    net = language_id.Network(names, *(random.normal(0, 0.7, s).astype(np.float32) for s in shapes))
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def layer(k, data):
        state, out = [0.0] * n, []
        for byte in data:
            given = [float(v) for v in net.inputs[k][byte]]
            carried = [sum(state[j] * float(net.recur[k][j][i]) for j in range(n)) for i in range(3 * n)]
            update = [sigmoid(given[i] + carried[i]) for i in range(n)]
            reset = [sigmoid(given[n + i] + carried[n + i]) for i in range(n)]
            fresh = [math.tanh(given[2 * n + i] + reset[i] * carried[2 * n + i]) for i in range(n)]
            state = [f + u * (s - f) for f, u, s in zip(fresh, update, state, strict=True)]
            out.append(state)
        return out

    def brute(data):
        total = [0.0] * 3
        for at in range(0, len(data), language_id.WINDOW):
            window = data[at : at + language_id.WINDOW]
            # The backward layer reads the window with what fills it up, from its end.
            filled = window + bytes(language_id.WINDOW - len(window))
            ahead, back = layer(0, filled), layer(1, filled[::-1])[::-1]
            for t in range(len(window)):
                logits = [
                    sum(ahead[t][j] * float(net.output[0][j][c]) + back[t][j] * float(net.output[1][j][c]) for j in range(n))
                    + float(net.offset[c])
                    for c in range(3)
                ]
                high = max(logits)
                parts = [math.exp(v - high) for v in logits]
                total = [x + p / sum(parts) for x, p in zip(total, parts, strict=True)]
        return [x / max(1, len(data)) for x in total]

    texts = [b"a", b"The quick brown fox", "ça été là ".encode() * 40, bytes(range(1, 255))]
    found = net.predict(texts)
    for row, text in zip(found, texts, strict=True):
        assert row == pytest.approx(brute(text), abs=1e-4)
    assert net.predict([b""])[0].tolist() == [0, 0, 0]


def test_an_id_in_very_many_rows_takes_one_place(spark, monkeypatch):
    """The sample of the network and that of the trees hold one text of it, in every run the same."""
    from pyspark.sql import functions as F

    hot = spark.range(100_000).select(
        F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("hot text "), "id").alias("text"), F.lit("en").alias("lang")
    )
    rest = spark.range(10, 60).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
    )
    documents = hot.unionByName(rest).repartition(6)
    samples = []
    monkeypatch.setattr(language_id, "fit", lambda w, sizes, labels, names: samples.append((len(w), w.tobytes())))
    for _ in range(2):
        language_id.train(documents, per_language=1000)
    learned = sum(bucket(i, 3) != 1 for i in [2, *range(10, 60)])
    assert samples[0] == samples[1] and samples[0][0] == learned
    labels = documents.select("doc_id", (F.col("doc_id") % 2).alias("quality")).distinct()
    fits = []
    monkeypatch.setattr(quality, "fit", lambda rows, good: fits.append((rows.tobytes(), good.tolist())))
    for _ in range(2):
        quality.train(documents, labels)
    assert fits[0] == fits[1] and len(fits[0][1]) == sum(bucket(i, 5) != 0 for i in [2, *range(10, 60)])


# quality


def test_quality_of_held_out_documents(spark, sf_gate):
    found = quality.op10_quality_classifier(spark, sf_gate)
    labels = spark.read.parquet(f"{sf_gate}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all(bucket(r.doc_id, 5) == 0 and (r.predicted == 1) == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows) > 50


def test_trees_find_a_rule_and_flat_arrays_follow_it():
    random = np.random.default_rng(2)
    rows = random.normal(0, 1, (4000, 3)).astype(np.float32)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > -0.2)).astype(float)
    model = quality.fit(rows[:3000], labels[:3000])
    assert ((model.score(rows[3000:]) > 0.5) == labels[3000:]).mean() > 0.95
    for row in rows[:20]:  # one row at a time, by hand
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        assert model.score(row[None])[0] == pytest.approx(1 / (1 + math.exp(-total)))


def test_odd_quality(spark, odd, none):
    labels = [(1, 1, "x"), (3, 0, "x"), (3, 1, "x"), (7, None, "x"), (None, 1, "x"), (99, 0, "x"), (13, 0, "y")]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    model = quality.train(odd, frame)
    got = quality.score_quality(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(none, model).count() == 0
    empty = quality.train(odd, frame.limit(0))
    assert {r.score for r in quality.score_quality(odd, empty).collect()} == {0.5}


def test_statistics_do_not_depend_on_chunks(monkeypatch):
    texts = pa.array(["ABC def!! | 12", None, "", "é" * 50 + "\n" * 7, "x " * 400])
    whole = quality.statistics(texts)
    monkeypatch.setattr(quality, "CHUNK", 13)
    assert np.array_equal(whole, quality.statistics(texts))
    assert np.array_equal(whole[1:4], quality.statistics(texts.slice(1, 3)))


# language model


def test_counts_and_base_scores(odd, none):
    got = language_model.score_documents(odd).collect()
    tokens = [(r[0], (r[1] or "").encode().lower().split() + [None]) for r in ODD]
    counts = Counter()
    for doc, words in tokens:
        if bucket(doc, 7) != 2:
            counts.update(words)
    total = sum(counts.values())
    expected = sorted(
        (doc is None, doc or 0, bucket(doc, 7) == 2, len(words), sum(counts[w] > 0 for w in words), total)
        for doc, words in tokens
    )
    assert expected == sorted(
        (r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got
    )
    base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for _, ws in tokens for w in ws)
    assert sum(r.base_score for r in got) == pytest.approx(base)
    assert all(r.score < 0 for r in got)
    assert language_model.score_documents(none).count() == 0


def test_chances_of_a_context_add_up_to_one(spark, documents_of):
    rows = [(i, " ".join(f"w{(i * j) % 37}" for j in range(60)), "en", "a") for i in range(80)]
    rows += [(i, "only held out", "en", "a") for i in range(80, 90)]
    documents = documents_of(rows)
    model = [r.asDict() for r in language_model.train(documents.select("doc_id", "text"), 4).collect()]
    totals = np.sum([r["totals"] for r in model], 0)
    chances = [language_model.Chances(r, totals) for r in model]
    new = np.array([1], np.uint64)
    for context in (0, 3, 77, 200):
        sums = 10 ** chances[0].score(new, np.array([context]))[1][0]
        for part in chances:
            _, logs = part.score(part.words, np.full(len(part.words), context))
            sums += (10**logs).sum()
        assert sums == pytest.approx(1)


def test_held_out_text_is_likelier_than_by_single_words(spark, sf_gate):
    rows = language_model.op5_lm_scoring(spark, sf_gate).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_tables_lie_between_one_and_the_customers():
    random = np.random.default_rng(0)
    counts = np.array([1, 2, 5, 100, 10_000, 3_000_000])
    few = language_model.tables_of(counts, np.full(6, 0.01), 0.5, random)
    many = language_model.tables_of(counts, np.full(6, 50.0), 0.5, random)
    assert (few >= 1).all() and (many <= counts).all() and (many[2:] > few[2:]).all()


@pytest.mark.parametrize(("customers", "weight"), [(1, 5.0), (12, 0.4), (40, 30.0), (600, 8.0)])
def test_seating_against_one_customer_at_a_time(customers, weight):
    """The number of tables has the distribution that a plain Chinese restaurant gives."""
    random = np.random.default_rng(customers)
    discount = language_model.DISCOUNT

    def plain():
        tables = [1]
        for _ in range(customers - 1):
            seats = np.array([*(n - discount for n in tables), weight])
            chosen = random.choice(len(seats), p=seats / seats.sum())
            if chosen == len(tables):
                tables.append(1)
            else:
                tables[chosen] += 1
        return len(tables)

    runs = 150 if customers > 100 else 600
    wanted = np.array([plain() for _ in range(runs)], float)
    keys = random.integers(0, 2**63, 4000).astype(np.uint64)
    found = language_model.tables_of(np.full(4000, customers), np.full(4000, weight), discount, keys=keys)
    error = 4 * math.sqrt(wanted.var() / runs + found.var() / 4000) + 1e-9
    # Groups of a sixteenth, from the 256th customer on, are seated by the chance at their middle.
    assert abs(found.mean() - wanted.mean()) <= error + (0.02 * wanted.mean() if customers > 256 else 0)
    assert found.std() == pytest.approx(wanted.std(), rel=0.35, abs=0.05)


def test_perplexity_is_that_of_the_score(odd):
    for row in language_model.score_documents(odd).collect():
        assert row.perplexity == pytest.approx(10 ** (-row.score / row.n_tokens))


def test_the_whole_word_before_is_the_context(spark, documents_of):
    rows = [(i, "the alpha " * 30 + "she beta " * 30, "en", "a") for i in range(40)]
    documents = documents_of(rows).select("doc_id", "text")
    [row] = [r.asDict() for r in language_model.train(documents, 1).collect()]
    chances = language_model.Chances(row, np.array(row["totals"]))
    hashes, *_ = language_model.tokens(["the she alpha"])
    end, the, she, alpha = hashes
    _, logs = chances.score(np.array([alpha, alpha]), np.array([the, she]))
    assert logs[0] > logs[1] + 1  # 'the' and 'she' end alike
    for context in (end, the, she, alpha):
        words = np.r_[chances.words, np.uint64(1)]  # and one that is new
        _, logs = chances.score(words, np.full(len(words), context))
        assert (10**logs).sum() == pytest.approx(1)


def test_scores_are_those_of_one_bucket_with_all(spark, documents_of):
    rows = [(i, " ".join(f"w{(i * j * j) % 23}" for j in range(50)), "en", "a") for i in range(60)]
    documents = documents_of(rows)
    got = {r.doc_id: r.score for r in language_model.score_documents(documents).collect()}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = [r.asDict() for r in language_model.train(documents.select("doc_id", "text"), buckets).collect()]
    totals = np.sum([r["totals"] for r in model], 0)
    parts = [language_model.Chances(r, totals) for r in model]
    for doc, text, *_ in rows[:12]:
        hashes, place, _, before = language_model.tokens([text])
        seen, customers = sum(p.of_names(hashes)[0] for p in parts)
        in_parent, in_context = sum(p.of_names(hashes)[1] for p in parts)
        cells = [p.of_cells(hashes[place], hashes[before]) for p in parts]
        above = language_model.chance_above(seen, in_parent, totals)[:, place]
        chance = language_model.chance(
            sum(c for c, _ in cells), sum(t for _, t in cells), customers[before], in_context[:, before], above
        )
        assert got[doc] == pytest.approx(np.log10(chance.mean(0)).sum())


def test_seating_does_not_depend_on_the_number_of_buckets(documents_of):
    rows = [(i, " ".join(f"w{(i * j * j) % 23}" for j in range(50)) + " hot" * 40, "en", "a") for i in range(60)]
    documents = documents_of(rows).select("doc_id", "text")
    seated = []
    for buckets in (1, 5):
        cells = {}
        for row in language_model.train(documents, buckets).collect():
            part = language_model.Chances(row.asDict(), np.array(row["totals"]))
            pairs = zip(part.cell_words.tolist(), part.cell_contexts.tolist(), strict=True)
            cells |= dict(zip(pairs, zip(part.counts.tolist(), *part.seated.tolist(), strict=True), strict=True))
        seated.append(cells)
    assert seated[0] == seated[1] and max(c[0] for c in seated[0].values()) > 2 * language_model.SINGLE
    assert len({c[1:] for c in seated[0].values()}) > 5


def test_documents_are_scored_in_rounds(spark, odd, monkeypatch):
    """Only a part of the documents asks at once; the number of rounds changes no row."""
    from tillroll.llm import common

    def rows():
        return sorted(map(repr, language_model.score_documents(odd).collect()))

    stored = []
    monkeypatch.setattr(language_model, "store", lambda df, name: stored.append(name) or common.store(df, name))
    three = rows()
    assert stored.count("scores") == language_model.ROUNDS > 1
    monkeypatch.setattr(language_model, "ROUNDS", 1)
    assert rows() == three


def test_notes_between_buckets_go_by_crews(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i * k % 61} w{k % 7}" for k in range(60))) for i in range(300)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    buckets, stored, answers, models = 19, language_model.store, [], []

    def counting(df, name):
        out = stored(df, name)
        if name == "totals":
            answers[-1].append(out.where("kind = 'answer'").count())
        return out

    monkeypatch.setattr(language_model, "store", counting)
    for direct in (buckets, 1):
        monkeypatch.setattr(language_model, "DIRECT", direct, raising=False)
        answers.append([])
        models.append(sorted(map(repr, language_model.train(documents, buckets).collect())))
    # 19 buckets are four crews of five: no bucket writes to more than four others.
    assert min(answers[0]) > 200 and max(answers[1]) <= 4 * buckets
    assert models[0] == models[1]


def test_words_are_split_at_ascii_white_space():
    odd = [None, "", " \t", " a  B\x0b\x0c\r\nb a ", "\x1c\x1f \x85 \xa0 cİ \x00", "A"]
    place_of = {b"": 0}
    want = [[place_of.setdefault(w, len(place_of)) for w in [*shingles.words(t), b""]] for t in odd]
    hashes, place, document, before = language_model.tokens(odd)
    assert place.tolist() == [p for own in want for p in own]
    assert document.tolist() == [i for i, own in enumerate(want) for _ in own]
    assert before.tolist() == [p for own in want for p in [0, *own[:-1]]]
    assert hashes[1:].tolist() == [xxh3_64_intdigest(w) for w in place_of][1:]


def test_pairs_are_sorted_and_numbered_in_full():
    rng = np.random.default_rng(5)
    rank = rng.integers(0, 9, 2000)
    # Contexts that differ in their last bits only, which a number of both leaves out.
    contexts = np.uint64(1 << 63) + rng.integers(0, 8, 2000).astype(np.uint64)
    order, plain = language_model._by_pair(rank, contexts, 9), np.lexsort((contexts, rank))
    assert (rank[order] == rank[plain]).all() and (contexts[order] == contexts[plain]).all()
    for largest in (7, 1 << 62):
        keys = rng.integers(0, largest, 2000)
        for found, want in zip(
            language_model._numbered(keys, largest), np.unique(keys, return_inverse=True), strict=True
        ):
            assert (found == want).all()
        assert (language_model._different(keys) == np.unique(keys)).all()
