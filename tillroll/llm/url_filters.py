"""Allow and block rules for URLs, found by a sweep over sorted intervals.

Every key is text whose prefixes are its ancestors: a host is written backwards, label by
label (``www.example.com`` becomes ``com.example.www.``), so a rule's host and all its
subdomains are the interval of keys that start with the rule's key. Prefix intervals are
either nested or apart. A sweep over the sorted boundaries and points therefore keeps a stack:
an opening boundary pushes, a closing one pops, and what is on the stack at a point are the
rules that hold there, outermost first.

Two sweeps decide a URL. The first finds the rule hosts above its host. The second goes over
``host key + path`` for each of them and finds the longest rule path that the URL's path
starts with. The longest rule text wins; of two of one length the longer host wins.

On Spark the sweep is a range partitioning by key and id, so that one hot host or URL is cut
into several partitions, and windows inside each partition. The stack is one window column
for each depth: at depth k it has the rule that opened last at that depth, and it counts as
far as the current depth, a running sum of openings less closings. What was open where a
partition begins comes from the partitions before it: one row for each of them.

Defined results: a null URL or one without ``://`` has an empty host and path and gets the
default verdict. Rows with the same id and URL are judged once for each row. Rules with a
null or empty host are ignored; a null path counts as ``/``; of rules with the same host and
path, block wins. Further columns of either input are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import ascii_lower, forget, store, table

ALLOW, BLOCK = "allow", "block"

#: The rules of the query: verdict, host, path.
RULES = [
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
]

#: After the last key that starts with a prefix: no UTF-8 text holds this byte.
END = "FF"


@dataclass
class Swept:
    rows: DataFrame
    stored: list[DataFrame]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """The labels from last to first, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def sweep(points: DataFrame, prefixes: DataFrame, partitions: int) -> Swept:
    """For every point the prefixes that its key starts with, as ``stack``, shortest first.

    ``points`` has ``key`` and any columns that do not begin with ``_``; ``prefixes`` has
    distinct ``key``s only. Native: a range shuffle, a sort and windows.
    """
    carried = [c for c in points.columns if c != "key"]
    body = F.struct(*carried) if carried else F.struct(F.lit(0).alias("none"))
    # Keys are compared as bytes. At one key, what opens comes before the points; END sorts
    # behind all that begin alike.
    key = F.col("key").cast("binary").alias("key")
    opening = prefixes.select(
        key, F.lit(0).alias("_kind"), F.col("key").alias("_prefix"), F.lit(1).alias("_step")
    )
    closing = prefixes.select(
        F.concat(F.col("key").cast("binary"), F.unhex(F.lit(END))).alias("key"),
        F.lit(2).alias("_kind"),
        F.col("key").alias("_prefix"),
        F.lit(-1).alias("_step"),
    )
    nothing = opening.unionByName(closing).withColumn("_body", F.lit(None).cast(_type(points, body)))
    shown = points.select(
        key,
        F.lit(1).alias("_kind"),
        F.lit(None).cast("string").alias("_prefix"),
        F.lit(0).alias("_step"),
        body.alias("_body"),
    )
    # Closings of nested prefixes meet only where one extends the other: longest first.
    inner = -F.length(F.coalesce("_prefix", F.lit("")))
    spread = (
        nothing.unionByName(shown)
        .withColumn("_inner", F.when(F.col("_kind") == 2, inner).otherwise(0))
        .withColumn("_salt", F.xxhash64("_body"))
        .repartitionByRange(partitions, "key", "_kind", "_inner", "_salt")
        .withColumn("_part", F.spark_partition_id())
    )
    stored = store(spread, "sweep")

    steps = stored.where("_step <> 0")
    order = ["key", "_kind", "_inner"]
    total = steps.groupBy("_part").agg(F.sum("_step").alias("_change"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row for each partition that holds a boundary; with few rules these are few.
    before = total.select(
        "_part", F.coalesce(F.sum("_change").over(earlier), F.lit(0)).alias("_before")
    )
    parts = stored.select("_part").distinct()
    every = (
        parts.join(total, "_part", "left")
        .select("_part", F.coalesce("_change", F.lit(0)).alias("_change"))
        .select("_part", F.coalesce(F.sum("_change").over(earlier), F.lit(0)).alias("_before"))
    )
    within = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    opened = (
        steps.join(before, "_part")
        .withColumn("_depth", F.col("_before") + F.sum("_step").over(within))
        .where("_step = 1")
        .select("_part", *order, "_prefix", "_depth")
    )
    opened = store(opened, "opened")
    deepest = opened.agg(F.max("_depth")).first()[0] or 0
    slots = range(1, deepest + 1)
    # What each partition finds open: the last opening at each depth before it.
    last = opened.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_openings"),
        *(
            F.max_by("_prefix", F.when(F.col("_depth") == k, F.struct(*order))).alias(f"_last{k}")
            for k in slots
        ),
    )
    found = (
        every.join(last, "_part", "left")
        .select(
            "_part",
            "_before",
            *(
                F.last(f"_last{k}", ignorenulls=True).over(earlier).alias(f"_found{k}")
                for k in slots
            ),
        )
    )
    depth = F.col("_before") + F.sum("_step").over(within)
    here = stored.join(found, "_part").withColumn("_depth", depth)
    slot = [
        F.coalesce(
            F.last(
                F.when((F.col("_step") == 1) & (F.col("_depth") == k), F.col("_prefix")),
                ignorenulls=True,
            ).over(within),
            F.col(f"_found{k}"),
        ).alias(f"_slot{k}")
        for k in slots
    ]
    held = here.select("key", "_kind", "_body", "_depth", *slot).where("_kind = 1")
    whole = F.array(*(f"_slot{k}" for k in slots)) if deepest else F.array().cast("array<string>")
    stack = F.slice(whole, F.lit(1), F.col("_depth").cast("int"))
    rows = held.select(
        *(F.col(f"_body.{c}").alias(c) for c in carried), stack.alias("stack")
    )
    return Swept(rows, [stored, opened])


def _type(points: DataFrame, body: Column) -> str:
    return points.select(body.alias("b")).schema["b"].dataType.simpleString()


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    default: str = ALLOW,
    partitions: int | None = None,
) -> DataFrame:
    """The verdict on each page's ``url``: id, host, path, rule (null if none), verdict."""
    spark = pages.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    clean = (
        rules.select(
            F.col("verdict"),
            ascii_lower(F.col("host")).alias("host"),
            F.coalesce("path", F.lit("/")).alias("path"),
        )
        .where("host <> ''")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block sorts behind allow
        .withColumn("above", host_key(F.col("host")))
    )
    clean = store(clean, "rules")
    # Each row gets a number of its own, so that repeated rows stay apart.
    split = pages.select(
        F.col(id_column).alias("page"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.monotonically_increasing_id().alias("line"),
    )
    split = store(split, "urls")

    hosts = sweep(
        split.select(host_key(F.col("host")).alias("key"), "line", "path"),
        clean.select(F.col("above").alias("key")).distinct(),
        partitions,
    )
    fitting = hosts.rows.select("line", "path", F.explode("stack").alias("above")).select(
        F.concat("above", F.lit("\t"), "path").alias("key"), "line", "above"
    )
    keyed = clean.withColumn("key", F.concat("above", F.lit("\t"), "path"))
    paths = sweep(fitting, keyed.select("key").distinct(), partitions)
    # The innermost prefix is the longest path of that host.
    longest = paths.rows.where(F.size("stack") > 0).select(
        "line", F.element_at("stack", -1).alias("key")
    )
    named = keyed.select(
        "key",
        "verdict",
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("wide"),
    )
    rank = F.struct(F.length("rule"), "wide", "rule")
    won = (
        longest.join(named, "key")
        .groupBy("line")
        .agg(F.max_by(F.struct("rule", "verdict"), rank).alias("won"))
    )
    result = split.join(won, "line", "left").select(
        F.col("page").alias(id_column),
        "host",
        "path",
        F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"),
    )
    result = store(result, "verdicts")
    forget(spark, clean, split, *hosts.stored, *paths.stored)
    return result


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_frame(spark, RULES))


OP2_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
           THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         row_number() OVER () AS line FROM parts),
rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT line, h || p AS rule, v,
         row_number() OVER (PARTITION BY line ORDER BY length(h || p) DESC, length(h) DESC) AS n
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM split LEFT JOIN fits ON split.line = fits.line AND n = 1
"""
