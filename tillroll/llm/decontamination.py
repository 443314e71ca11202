"""Benchmark items found inside documents: MinHash containment search, verified exactly.

An item is contained in a document if at least three quarters of the item's different word
shingles are in the document. Items are partitioned by size: class c holds items of more than
2^(c-1) and at most 2^c shingles. The signature of an item is its smallest shingle hashes, as
many as the largest size of its class can spare, plus one. A document that lacks all of them
lacks more than a quarter of the item, so however long the document, no item is missed. The
document's side is its whole text: every shingle hash is looked up among the signatures.

The documents and items so found are verified: the shingles themselves, as text, are counted.

Native: arrays and joins only. Signatures and candidates are broadcast behind a check of their
number and joined by shuffle beyond it, where adaptive execution splits hot hashes. Nothing is
kept for a document that meets no signature, and a document's hits on an item are merged in
the task before any shuffle.

Defined results: words are compared with A-Z lower-cased. An item of fewer than ``WIDTH`` words
is one shingle of its own length; items and texts that are null or have no word contain nothing
and are in nothing. Rows with one doc_id are one document and so are those without; rows with one
item_id and different texts are items of their own, of which the best counts. Further columns
are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import ascii_lower, bounded_broadcast, forget, store, table, word_list

WIDTH = 5
PERCENT = 75
#: Broadcast up to so many rows of hashes, ids or shingles, else shuffle.
BROADCAST_ROWS = 500_000


def _windows(items: Column | str, width: int, combine) -> Column:
    """``combine`` of every ``width`` neighbours in an array."""
    count = F.size(items) - (width - 1)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: combine([F.get(items, i + k) for k in range(width)]))


def shingle_hashes(hashes: Column | str, width: int) -> Column:
    return _windows(hashes, width, lambda parts: F.xxhash64(*parts))


def shingle_texts(words: Column | str, width: int) -> Column:
    return _windows(words, width, lambda parts: F.concat_ws(" ", *parts))


def _words(text: str) -> Column:
    return word_list(ascii_lower(F.col(text)))


def item_table(benchmark: DataFrame) -> DataFrame:
    """item, item_id, width, n and shingles (different ones, as text and as hashes)."""
    read = benchmark.select(
        F.xxhash64("item_id", "text").alias("item"), "item_id", _words("text").alias("words")
    ).where(F.size("words") > 0).distinct()
    by_width = None
    for width in range(1, WIDTH + 1):
        fits = F.size("words") == width if width < WIDTH else F.size("words") >= width
        hashed = F.transform("words", lambda w: F.xxhash64(w))
        part = read.where(fits).select(
            "item",
            "item_id",
            F.lit(width).alias("width"),
            F.array_distinct(shingle_texts(F.col("words"), width)).alias("shingles"),
            F.array_distinct(shingle_hashes(hashed, width)).alias("hashes"),
        )
        by_width = part if by_width is None else by_width.unionByName(part)
    return by_width.withColumn("n", F.size("shingles"))


def signatures(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """hash, item, width: the signature of every item by its size class."""
    largest = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int")
    spare = largest - F.ceil(largest * F.lit(percent) / 100)
    return items.select(
        "item",
        "width",
        F.explode(F.slice(F.sort_array("hashes"), F.lit(1), (spare + 1).cast("int"))).alias("hash"),
    )


def find_items(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, n_shingles, n_common for every item that a document contains."""
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")  # other columns may have our names
    items = store(item_table(benchmark), "items")
    signed = bounded_broadcast(signatures(items, percent), BROADCAST_ROWS)
    widths = [r[0] for r in items.select("width").distinct().collect()]  # five at most
    if not widths:
        return spark.createDataFrame([], "doc_id long, item_id long, n_shingles int, n_common long")
    hashed = documents.select(
        F.col("doc_id"), F.transform(_words("text"), lambda w: F.xxhash64(w)).alias("hashes")
    )
    met = None
    for width in widths:
        shown = hashed.select("doc_id", F.explode(shingle_hashes("hashes", width)).alias("hash"))
        part = shown.join(signed.where(F.col("width") == width), "hash").select("doc_id", "item")
        met = part if met is None else met.unionByName(part)
    met = store(met.distinct(), "met")

    holders = bounded_broadcast(
        met.select(F.col("doc_id").alias("holder")).distinct(), BROADCAST_ROWS
    )
    suspects = documents.join(
        holders, F.col("doc_id").eqNullSafe(F.col("holder")), "left_semi"
    ).select("doc_id", _words("text").alias("words"))
    texts = bounded_broadcast(
        items.select("item", "width", F.explode("shingles").alias("shingle")), BROADCAST_ROWS
    )
    common = None
    for width in widths:
        told = suspects.select(
            "doc_id", F.explode(F.array_distinct(shingle_texts("words", width))).alias("shingle")
        )
        part = told.join(texts.where(F.col("width") == width), "shingle").select(
            "doc_id", "item", "shingle"
        )
        common = part if common is None else common.unionByName(part)
    wanted = met.select(F.col("doc_id").alias("in_doc"), F.col("item").alias("of_item"))
    counted = (
        common.join(
            wanted,
            F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("item") == F.col("of_item")),
            "left_semi",
        )
        .distinct()
        .groupBy("doc_id", "item")
        .agg(F.count(F.lit(1)).alias("n_common"))
    )
    return (
        counted.join(items.select("item", "item_id", "n"), "item")
        .where(100 * F.col("n_common") >= percent * F.col("n"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct(F.col("n_common") / F.col("n"), "n", "n_common")).alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n").alias("n_shingles"),
            F.col("best.n_common").alias("n_common"),
        )
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` that contain no item."""
    found = store(
        find_items(documents, benchmark, percent).select(F.col("doc_id").alias("leaked")).distinct(),
        "leaked",
    )
    leaked = bounded_broadcast(found, BROADCAST_ROWS)
    same = documents["doc_id"].eqNullSafe(leaked["leaked"])
    return documents.join(leaked, same, "left_anti")


def decontaminate_rows(
    documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``documents`` whose own text contains no item, whatever other rows share the id."""
    key = F.md5(F.col("text").cast("binary"))
    keyed = documents.select(key.alias("doc_id"), "text")
    found = find_items(keyed, benchmark, percent)
    found = store(found.select(F.col("doc_id").cast("string").alias("leaked")).distinct(), "leaked")
    leaked = bounded_broadcast(found, BROADCAST_ROWS)
    same = F.md5(documents["text"].cast("binary")) == leaked["leaked"]
    return documents.join(leaked, same, "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SHINGLES = """
  SELECT {id}, {width} AS width, array_to_string(words[i:i + {width} - 1], ' ') AS shingle
  FROM (SELECT {id}, words, unnest(generate_series(1, len(words) - {width} + 1)) AS i
        FROM {words})
"""

OP1_SQL = f"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM benchmark),
d AS (SELECT DISTINCT * FROM ({_SHINGLES.format(id="doc_id", width=WIDTH, words="doc_words")})),
b AS (SELECT DISTINCT * FROM ({_SHINGLES.format(id="item_id", width=WIDTH, words="item_words")})),
sizes AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS n_shingles, count(*) AS n_common
FROM d JOIN b USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= {PERCENT} * any_value(n)
"""
