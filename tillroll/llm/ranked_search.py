"""The best documents for each item of a query set, by pipelined term partitioning.

The index is partitioned by term: every term of the items has one owner, and an owner keeps the
whole inverted lists of its terms. Items travel in bundles from owner to owner. A bundle carries,
for each of its items, a sparse accumulator of documents and integer scores; the owner adds what
its terms contribute and hands the bundle on. After the last owner the best are selected.

Owners are ordered by how many documents their terms have, rare terms first. Rare terms weigh
most, so after the first owners the k-th best score of an item is known to be at least some
bound. A document is dropped, or not taken up at all, once its score and all that the coming
terms can add at most stay below the bound. That leaves out only documents that cannot be among
the best k; the result is the same as with every posting added up.

On Spark each owner is one stage: the postings of the owner, stored under it, are cogrouped with
the bundles. The documents are dealt out to shards of about ``SHARD_DOCUMENTS``, so the list of
a term that a third of all documents hold is cut into as many parts as there are shards, and a
group has one bundle and one shard. Between stages the bundles are stored, and one small
aggregate takes the k-th best score of each item over all shards.

Defined results: terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A
null text has no terms; documents without terms count for nothing. Every row of ``documents`` is
a document, also where ids repeat; null ids come last among equal scores. Every row of ``items``
is an item of its own; items without a term that any document holds give no rows. Further columns
of either input are ignored. Empty tables give no rows. Sums are 64-bit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import (
    bounded_broadcast,
    collect_garbage,
    forget,
    give_back_memory,
    ship,
    small,
    store,
    table,
)
from tillroll.sources.staging import new_folder

K = 10
SHARD_DOCUMENTS = 4096
BUNDLE_ITEMS = 256
#: Terms in at most this share of the documents belong to the first owner, and so on.
OWNER_SHARES = (1 / 1024, 1 / 64, 1 / 8)
#: Up to so many terms of the items, or items, are sent to every task.
MOST_TERMS = 200_000

#: Bytes outside of terms become blanks, A-Z small letters; UTF-8 bytes above 127 stay.
TERM_BYTES = bytes(
    b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)
POSTINGS = "owner int, bundle int, shard int, number long, line long, place long, gain long"
STATE = (
    "bundle int, shard int, item long, bound long, rest long, numbers array<long>, "
    "tops array<long>, owners array<int>, lines array<long>, places array<long>, "
    "scores array<long>, best array<long>"
)
STATE_NAMES = [part.split()[0] for part in STATE.split(", ")]


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def term_counts(texts: DataFrame, key: str, wanted: frozenset[bytes] | None) -> DataFrame:
    """``key``, ``n`` (terms with repeats), ``terms`` and ``counts``: different terms, only the
    wanted ones if these are given."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts, bounds = [], [], [], [0]
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = terms_of(text)
                sizes.append(len(found))
                held = Counter(found if wanted is None else filter(wanted.__contains__, found))
                terms.extend(held)
                counts.extend(held.values())
                bounds.append(len(terms))
            offsets = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                [key, "n", "terms", "counts"],
            )
        give_back_memory()

    schema = f"{key} long, n long, terms array<string>, counts array<long>"
    return texts.select(F.col(key).cast("long").alias(key), "text").mapInArrow(counted, schema)


def advance(
    bundle: pa.Table, postings: pa.Table, owner: int, k: int, final: bool
) -> pa.Table:
    """A bundle in one shard after the terms of one owner. At the end only the best k of each
    item stay."""
    number, line, place, gain = (
        postings.column(c).to_numpy() for c in ("number", "line", "place", "gain")
    )
    held = bundle.column("lines").combine_chunks()
    bounds = held.offsets.to_numpy()
    state = [
        bundle.column(c).combine_chunks().values.to_numpy() for c in ("lines", "places", "scores")
    ]
    # The documents of this shard that anything here speaks of, and where each is among them.
    lines, first = np.unique(np.concatenate([line, state[0]]), return_index=True)
    places = np.concatenate([place, state[1]])[first]
    order = np.argsort(number, kind="stable")
    at, gain = np.searchsorted(lines, line[order]), gain[order]
    keys, begins = np.unique(number[order], return_index=True)
    ends = np.r_[begins, len(order)][1:]
    lists = {key: slice(a, b) for key, a, b in zip(keys.tolist(), begins, ends, strict=True)}

    carried = ["item", "bound", "rest", "numbers", "tops", "owners"]
    rows = {name: [] for name in [*carried, "best"]}
    out, sizes = ([], [], []), [0]
    for i, item in enumerate(bundle.select(carried).to_pylist()):
        bound, rest = item["bound"], item["rest"]
        scores = np.zeros(len(lines), np.int64)
        alive = np.zeros(len(lines), bool)
        mine = np.searchsorted(lines, state[0][bounds[i] : bounds[i + 1]])
        scores[mine] = state[2][bounds[i] : bounds[i + 1]]
        alive[mine] = True
        for term, top, of in zip(item["numbers"], item["tops"], item["owners"], strict=True):
            if of != owner:
                continue
            if term in lists:
                where = at[lists[term]]
                scores[where] += gain[lists[term]]
                if rest >= bound:  # documents met for the first time here can still get there
                    alive[where] = True
            rest -= top
        alive &= scores + rest >= bound
        live = np.flatnonzero(alive)
        if len(live) > k:
            worst = np.partition(scores[live], -k)[-k]
            bound = max(bound, int(worst))
            live = live[scores[live] + rest >= bound]
        if final and len(live) > k:
            live = live[np.lexsort((lines[live], places[live], -scores[live]))[:k]]
        if not len(live) and (final or rest < bound):
            continue
        best = np.sort(scores[live])[::-1][:k]
        rows["item"].append(item["item"])
        rows["bound"].append(bound)
        rows["rest"].append(rest)
        for name in ("numbers", "tops", "owners"):
            rows[name].append([] if final else item[name])
        rows["best"].append(best)
        sizes.append(sizes[-1] + len(live))
        for kept, values in zip(out, (lines, places, scores), strict=True):
            kept.append(values[live])
    offsets = pa.array(sizes, pa.int32())
    lists_of = [
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *kept])))
        for kept in out
    ]
    count = len(rows["item"])
    same = [
        pa.array(np.full(count, bundle.column(c)[0].as_py() if count else 0), pa.int32())
        for c in ("bundle", "shard")
    ]
    long_list = pa.list_(pa.int64())
    return pa.Table.from_arrays(
        [
            *same,
            *(pa.array(rows[c], pa.int64()) for c in ("item", "bound", "rest")),
            *(pa.array(rows[c], long_list) for c in ("numbers", "tops")),
            pa.array(rows["owners"], pa.list_(pa.int32())),
            *lists_of,
            pa.array(rows["best"], long_list),
        ],
        names=STATE_NAMES,
    )


def _quotient(total: int, words: int) -> Column:
    """What a term with ``tf`` in a document of ``n`` terms adds for each unit of its weight."""
    length = f"(10 + ((90 * n * {total}L) div {words}L))"
    return F.expr(f"(1000000000L * tf) div (1000 * tf + 8 * {length})")


def _index(held: DataFrame, asked: DataFrame, shares: tuple[float, ...]) -> tuple:
    """The terms of the items that documents hold, with weight, greatest contribution and owner;
    the number of documents; and what each posting adds for a unit of weight."""
    total, words = held.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not total:
        return None, 0, None
    quotient = _quotient(total, words)
    share = F.col("df") / F.lit(float(total))
    ratio = F.lit(2.0 * total + 2) / (2 * F.col("df") + 1).cast("double")
    owner = sum((F.when(share > s, 1).otherwise(0) for s in shares), F.lit(0))
    owners = (
        held.select("n", F.inline("found").alias("term", "tf"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.max(quotient).alias("most"))
        .join(asked.select("term").distinct(), "term", "left_semi")
        .withColumn("weight", F.floor(1000 * F.log(ratio)).cast("long"))
        .select(
            "term",
            "weight",
            (F.col("weight") * F.col("most")).alias("top"),
            owner.cast("int").alias("owner"),
            F.monotonically_increasing_id().alias("number"),
        )
    )
    return store(owners, "owners"), total, quotient


def _bundles(terms: DataFrame, shards: int) -> DataFrame:
    """Every bundle at its start: the items' terms in the order of their owners, no documents."""
    order = F.struct("owner", (-F.col("top")).alias("less"), "number")
    nothing = F.array().cast("array<long>")
    return (
        terms.groupBy("item", "bundle")
        .agg(F.sort_array(F.collect_list(order)).alias("each"), F.sum("top").alias("rest"))
        .select(
            "bundle",
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            "item",
            F.lit(1).cast("long").alias("bound"),
            "rest",
            F.col("each.number").alias("numbers"),
            F.transform("each", lambda t: -t["less"]).alias("tops"),
            F.col("each.owner").alias("owners"),
            *(nothing.alias(c) for c in ("lines", "places", "scores", "best")),
        )
    )


def _pass_on(bundles: DataFrame, postings: DataFrame, owner: int, k: int, final: bool) -> DataFrame:
    """All bundles after one owner."""

    def of_group(bundle: pa.Table, lists: pa.Table) -> pa.Table:
        give_back_memory()
        return advance(bundle, lists, owner, k, final)

    key = ["bundle", "shard"]
    of_owner = postings.where(F.col("owner") == owner)
    return bundles.groupBy(*key).cogroup(of_owner.groupBy(*key)).applyInArrow(of_group, STATE)


def _raise_bounds(bundles: DataFrame, k: int) -> DataFrame:
    """The k-th best score that each item has reached over all shards becomes its bound."""
    order = W.partitionBy("item").orderBy(F.desc("score"))
    reached = (
        bundles.select("item", F.explode("best").alias("score"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") == k)
        .select("item", F.col("score").alias("reached"))
    )
    reached = bounded_broadcast(store(reached, "reached"), MOST_TERMS)
    bound = F.greatest("bound", F.coalesce("reached", F.lit(0)))
    return bundles.join(reached, "item", "left").withColumn("bound", bound).select(STATE_NAMES)


def search(
    documents: DataFrame,
    items: DataFrame,
    k: int = K,
    shard_documents: int = SHARD_DOCUMENTS,
    bundle_items: int = BUNDLE_ITEMS,
    owner_shares: tuple[float, ...] = OWNER_SHARES,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents with a score above 0 of each item."""
    spark = documents.sparkSession
    ship(spark)
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    numbered = store(
        items.select(F.col("item_id").cast("long"), "text").withColumn(
            "item", F.monotonically_increasing_id()
        ),
        "items",
    )
    asked = store(
        term_counts(numbered, "item", None).select("item", F.explode("terms").alias("term")),
        "item-terms",
    )
    vocabulary, wanted = asked.select("term").distinct(), None
    if small(vocabulary, most_terms):
        wanted = frozenset(r["term"].encode() for r in vocabulary.collect())
    # A null id sorts last; the lowest bit of ``line`` tells it from a real id.
    line = F.monotonically_increasing_id() * 2 + F.col("doc_id").isNull().cast("int")
    held = store(
        term_counts(documents, "doc_id", wanted)
        .where("n > 0")
        .select(
            line.alias("line"),
            F.coalesce("doc_id", F.lit(2**63 - 1)).alias("place"),
            "n",
            F.arrays_zip("terms", "counts").alias("found"),
        ),
        "term-counts",
    )
    owners, total, quotient = _index(held, asked, owner_shares)
    if not total:
        return empty
    bundles = max(1, -(-numbered.count() // bundle_items))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle")
    terms = store(asked.join(owners, "term").select("item", bundle, *owners.columns), "terms")
    stages = [r["owner"] for r in terms.select("owner").distinct().orderBy("owner").collect()]
    if not stages:
        return empty
    shards = max(1, -(-total // shard_documents))
    routes = terms.select("term", "bundle", "owner", "number", "weight").distinct()
    path = new_folder(spark, "postings")
    (
        held.select("line", "place", "n", F.inline("found").alias("term", "tf"))
        .join(bounded_broadcast(routes, most_terms), "term")
        .select(
            "owner",
            "bundle",
            F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int").alias("shard"),
            "number",
            "line",
            "place",
            (F.col("weight") * quotient).alias("gain"),
        )
        .write.partitionBy("owner")
        .parquet(path)
    )
    postings = spark.read.schema(POSTINGS).parquet(path)

    state, stored = _bundles(terms, shards), []
    for owner in stages:
        final = owner == stages[-1]
        stored.append(store(_pass_on(state, postings, owner, k, final), "bundles"))
        forget(spark, *stored[:-1])
        del stored[:-1]
        state = stored[0] if final else _raise_bounds(stored[0], k)
        collect_garbage(spark)
    order = W.partitionBy("item").orderBy(F.desc("score"), "place", "line")
    ranked = (
        state.select("item", F.inline(F.arrays_zip("lines", "places", "scores")))
        .toDF("item", "line", "place", "score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )
    result = store(
        ranked.join(numbered.select("item", "item_id"), "item").select(
            "item_id",
            "rank",
            F.when(F.col("line") % 2 == 0, F.col("place")).alias("doc_id"),
            "score",
        ),
        "ranked",
    )
    forget(spark, numbered, asked, held, owners, terms, postings, *stored)
    return result


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS line, doc_id, words, len(words) AS n
  FROM (SELECT doc_id, {_TERMS} AS words FROM documents) WHERE len(words) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM docs),
held AS (
  SELECT line, doc_id, n, term, count(*) AS tf
  FROM (SELECT line, doc_id, n, unnest(words) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT)
    AS w FROM held, total GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item, item_id, term
  FROM (SELECT item, item_id, unnest(words) AS term
        FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS words FROM benchmark))),
scored AS (
  SELECT item, item_id, line, doc_id, CAST(sum(w * ((1000000000 * tf) //
           (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), total
  GROUP BY item, item_id, line, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER)
    AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""
