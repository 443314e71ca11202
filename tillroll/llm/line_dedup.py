"""Lines that occur in many documents are dropped from all but one of them.

Lines are taken apart with their positions, normalised and hashed once, and stored. A first
aggregate leaves one row for each document and line key, a second counts the documents of each
key with partial sums in every task, so that a line in a third of all documents reaches its one
task as a few rows. Only keys over the threshold, stored too, come back to their lines. That
join may have hot keys; both sides are stored tables, so adaptive execution splits them. The
positions to drop are gathered for each document, and the document is put together again from
the positions that remain.

Defined results: a null or empty text is one empty line. Rows with the same id are one
document for counting, and each row is put together by itself; null is an id like any other
and the smallest. Keys shorter than ``min_length`` code points are never dropped. Further
columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import WHITE, ascii_lower, store, table

MIN_LENGTH = 20
MIN_DOCUMENTS = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def dedup_lines(
    documents: DataFrame,
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the text that is left, as ``kept``."""
    # A row is told apart by its id and text; rows equal in both fare alike.
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("body"))
    keyed = store(
        rows.select(
            "doc_id", "body", F.posexplode(lines_of(F.col("text"))).alias("position", "content")
        )
        .select("doc_id", "body", "position", line_key(F.col("content")).alias("key"))
        .where(F.length("key") >= min_length)
        .select("doc_id", "body", "position", F.unhex(F.md5("key")).alias("key")),
        "keyed-lines",
    )
    repeated = store(
        keyed.select("key", "doc_id")
        .distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("keeper"))
        .where(F.col("documents") >= min_documents)
        .select("key", "keeper"),
        "repeated-lines",
    )
    drops = (
        keyed.join(repeated, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("in_doc"), F.col("body").alias("in_body"))
        .agg(F.collect_set("position").alias("gone"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("body") == F.col("in_body"))
    taken_apart = rows.join(drops, same, "left").select(
        "doc_id", "gone", lines_of(F.col("text")).alias("lines")
    )
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.coalesce(F.array_except(places, F.col("gone")), places)
    return taken_apart.withColumn("left", left).select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_dropped"),
        F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n").alias("kept"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = dedup_lines(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS position, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT doc_id, position, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, position, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""
