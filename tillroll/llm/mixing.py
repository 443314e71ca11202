"""Mixing sources to target weights with blocks of equal numbers of words.

1. Sources in order of their code points, null last, weigh 5, 2, 1, 5, ...; the targets share
   all words by weight, and none is above three times its source's size. They are the level
   ``min(weight * level, 3 * size)`` at which the targets add up to all words: what resharing
   the excess again and again ends with.
2. Blocks have equal numbers of words. The number of blocks is apportioned to the sources by
   Sainte-Laguë: the highest of the quotients target / 1, target / 3, target / 5, ... win a
   block each. Each source's blocks are apportioned to its shards in the same way, by the
   shards' sizes, so a shard has an integer quota.
3. A shard has its documents in a seeded order, one after the other, cut into blocks. It gives
   every block as often as the quota holds whole rounds, and the rest of the quota is the
   blocks with the smallest seeded hashes. What a document gives is its share of the blocks.

A source is cut into shards of about ``SHARD_WORDS`` words by the document's hash, so one hot
source is many small groups. Sums for sources and shards are pre-aggregated. Tables of sources
and shards are small against the documents: a row for each source and for each shard.

Defined results: a null text has size 0, as has one without words. Empty sources have target 0.
A null source is a source of its own and comes last. Rows with the same id are separate
documents; rows equal in id and text lie next to each other. Further columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_broadcast, store, table, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20240607
SHARD_WORDS = 1 << 17
#: Shards of a source get their quotas in groups of so many at most.
SHARD_GROUP = 1024
LARGEST_BLOCK = 256
#: Blocks are small enough that the smallest target holds about so many.
BLOCKS_PER_SOURCE = 200
#: Above so many sources or shards they are joined by shuffle instead of broadcast.
BROADCAST_ROWS = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target from ``source, source_size``, one row for each source."""
    order = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    every = W.partitionBy(F.lit(1))
    number = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), number + 1).cast("double")
    ).withColumn("most", F.col("source_size") * float(MOST))
    # In order of most / weight the full sources come first: try the level after each of them.
    full = W.orderBy(F.col("most") / F.col("weight"), F.col("source").cast("binary"))
    before = full.rowsBetween(W.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # The first source that is not full at its level sets the level for all after it.
    tried = weighed.withColumn("level", level).withColumn("_place", F.row_number().over(full))
    free = F.col("weight") * F.col("level") <= F.col("most")
    first = F.min_by("level", F.when(free, F.col("_place"))).over(every)
    levelled = tried.withColumn("level", first)
    return levelled.select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("weight") * F.col("level"), F.col("most")), F.lit(0.0)).alias(
            "target"
        ),
    )


def apportion(
    claims: DataFrame, group: list[str], weight: str, seats: str, most: str, name: str
) -> DataFrame:
    """Sainte-Laguë in every group: ``name`` is the number of ``seats`` a claim wins.

    The highest quotients ``weight / (2k + 1)`` win, no claim more than ``most``. Quotients
    that are sure to win are counted, not listed: of m claims with the weights W, those above
    the quotient ``W / (2 * seats - m)`` are at least ``seats - m`` and never too many. A claim
    that has all it may win this way is closed and the others share the rest, until none is
    closed any more. Only what may win the last m seats is listed, about three quotients for a
    claim, and sorted.
    """
    all_of = W.partitionBy(*group) if group else W.partitionBy(F.lit(1))
    state = store(
        claims.withColumn("_claim", F.monotonically_increasing_id()).withColumn(
            "_closed", F.lit(False)
        ),
        "claims",
    )
    while True:
        opened = F.when(~F.col("_closed"), F.col(weight))
        left = F.col(seats) - F.coalesce(
            F.sum(F.when(F.col("_closed"), F.col(most))).over(all_of), F.lit(0)
        )
        counted = (
            state.withColumn("_left", left)
            .withColumn("_weights", F.sum(opened).over(all_of))
            .withColumn("_open", F.count(opened).over(all_of))
        )
        spread = 2.0 * F.col("_left") - F.col("_open")
        sure = F.floor((F.col(weight) * spread / F.col("_weights") + 1) / 2)
        counted = counted.withColumn(
            "_sure",
            F.when(F.col("_closed"), F.col(most))
            .when((spread >= 1) & (F.col("_weights") > 0), sure)
            .otherwise(0)
            .cast("long"),
        )
        full = ~F.col("_closed") & (F.col("_sure") >= F.col(most))
        state = store(
            counted.withColumn("_closes", full).withColumn("_closed", F.col("_closed") | full),
            "claims",
        )
        if state.where("_closes").isEmpty():
            break
        state = state.drop("_left", "_weights", "_open", "_sure", "_closes")
    rest = F.col(seats) - F.sum("_sure").over(all_of)
    width = F.ceil(F.col(weight) / F.col("_weights") * F.greatest("_open", "_rest")) + 1
    last = F.least(F.col("_sure") + width, F.col(most)) - 1
    listed = (
        state.withColumn("_rest", rest)
        .where(~F.col("_closed") & (F.col(weight) > 0))
        .where(last >= F.col("_sure"))
        .select(
            *group,
            "_claim",
            weight,
            "_rest",
            # Equal quotients are told apart by content, so that reruns agree.
            F.xxhash64(*claims.columns).alias("_tie"),
            F.explode(F.sequence("_sure", last)).alias("_k"),
        )
    )
    quotient = F.desc(F.col(weight) / (2 * F.col("_k") + 1))
    best = all_of.orderBy(quotient, "_tie", "_claim", "_k")
    won = (
        listed.withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= F.col("_rest"))
        .groupBy("_claim")
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    return state.join(won, "_claim", "left").select(
        *claims.columns, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias(name)
    )


def block_words(smallest_target: float) -> int:
    return max(1, min(LARGEST_BLOCK, int(smallest_target / BLOCKS_PER_SOURCE)))


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = SEED,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per row: doc_id, size, source_size, target of its source, taken; and for ``apply_mix`` the
    hash of its text, the number of its source and its shard."""
    spark = documents.sparkSession
    sized = store(
        documents.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64("text").alias("body"),
        ),
        "sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights)
    found = targets.agg(
        F.min(F.when(F.col("target") > 0, F.col("target"))).alias("smallest"),
        F.sum("source_size").alias("words"),
    ).first()
    block = block_words(found["smallest"] or 0.0)
    blocks = int((found["words"] or 0) / block + 0.5)

    def rounds_of(words: str) -> Column:
        return MOST * F.ceil(F.col(words) / block)

    sources = apportion(
        targets.withColumn("seats", F.lit(blocks).cast("long")).withColumn(
            "capacity", rounds_of("source_size")
        ),
        [], "target", "seats", "capacity", "source_blocks",
    ).select(
        "source",
        "source_size",
        "target",
        "source_blocks",
        F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).alias("shards"),
    ).withColumn("source_no", F.xxhash64(F.lit(seed), F.col("source").isNull(), "source"))
    sources = store(sources, "sources")
    by_source = bounded_broadcast(sources, BROADCAST_ROWS).withColumnRenamed("source", "its_source")
    placed = sized.join(by_source, F.col("source").eqNullSafe(F.col("its_source"))).select(
        "doc_id",
        "size",
        "body",
        "source_no",
        "source_size",
        "target",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "body"), F.col("shards")).alias("shard"),
    )

    # Shards in groups of a bounded number, so that no source's shards meet in one task.
    shards = (
        placed.groupBy("source_no", "shard")
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("shard_group", F.floor(F.col("shard") / SHARD_GROUP))
        .withColumn("capacity", rounds_of("shard_size"))
    )
    shards = store(shards, "shards")
    groups = (
        shards.groupBy("source_no", "shard_group")
        .agg(F.sum("shard_size").alias("group_size"), F.sum("capacity").alias("capacity"))
        .join(sources.select("source_no", F.col("source_blocks").alias("seats")), "source_no")
    )
    groups = apportion(groups, ["source_no"], "group_size", "seats", "capacity", "group_blocks")
    shards = shards.join(
        groups.select("source_no", "shard_group", F.col("group_blocks").alias("seats")),
        ["source_no", "shard_group"],
    )
    quotas = apportion(
        shards, ["source_no", "shard_group"], "shard_size", "seats", "capacity", "quota"
    )

    def draw(number: Column) -> Column:
        return F.xxhash64(F.lit(seed), F.col("source_no"), F.col("shard"), number)

    in_shard = F.ceil(F.col("shard_size") / block)
    extra = F.col("quota") % in_shard
    draws = F.sort_array(F.transform(F.sequence(F.lit(0).cast("long"), in_shard - 1), draw))
    quotas = quotas.where("shard_size > 0").select(
        "source_no",
        "shard",
        F.floor(F.col("quota") / in_shard).alias("rounds"),
        F.when(extra > 0, F.element_at(draws, extra.cast("int"))).alias("cutoff"),
    )

    line = W.partitionBy("source_no", "shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "doc_id", "body"), "doc_id", "body", "size"
    ).rowsBetween(W.unboundedPreceding, W.currentRow)
    laid = placed.withColumn("stop", F.sum("size").over(line)).withColumn(
        "start", F.col("stop") - F.col("size")
    )
    joined = laid.join(quotas, ["source_no", "shard"], "left")
    own = F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))

    def share(number: Column) -> Column:
        within = F.least(F.col("stop"), (number + 1) * block) - F.greatest(
            F.col("start"), number * block
        )
        return F.when(draw(number) <= F.col("cutoff"), within).otherwise(F.lit(0))

    drawn = F.aggregate(own, F.lit(0).cast("long"), lambda sum_, n: sum_ + share(n))
    taken = F.when(
        F.col("size") > 0,
        F.coalesce("rounds", F.lit(0)) * F.col("size")
        + F.when(F.col("cutoff").isNotNull(), drawn).otherwise(F.lit(0)),
    ).otherwise(F.lit(0))
    result = joined.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        "body",
        "source_no",
        "shard",
    )
    return result


def apply_mix(documents: DataFrame, mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it, in whole copies.

    A row whose words are taken 1.4 times is there once, and 0.4 are left over. In every shard
    the rows are put in order of size, and what is left over is added up along it; a row at which
    the sum passes a whole number (from a seeded start) is there once more. Neighbours are of like
    size, so what one has too much another has too little: a shard's words are off by its largest
    document at most, and a source's by less than one for each shard, as starts differ.
    """
    # Rows that are equal may differ in what is taken of each; together they count once.
    copies = (
        mixed.where("taken > 0")
        .select(
            F.col("doc_id").alias("m_id"),
            F.col("body").alias("m_body"),
            "source_no",
            "shard",
            "taken",
            "size",
        )
        .groupBy("m_id", "m_body", "source_no", "shard")
        .agg(F.avg("taken").alias("taken"), F.max("size").alias("size"))
        .withColumn("whole", F.floor(F.col("taken") / F.col("size")))
        .withColumn("over", F.col("taken") / F.col("size") - F.col("whole"))
    )
    in_order = (
        W.partitionBy("source_no", "shard")
        .orderBy("size", F.xxhash64(F.lit(seed + 2), "m_id", "m_body"), "m_id", "m_body")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    begin = (
        F.xxhash64(F.lit(seed + 3), "source_no", "shard").bitwiseAND(0xFFFFF) / float(1 << 20)
    )
    sum_ = F.sum("over").over(in_order) + begin
    copies = (
        copies.withColumn("sum", sum_)
        .withColumn(
            "times",
            (F.col("whole") + F.floor("sum") - F.floor(F.col("sum") - F.col("over"))).cast("int"),
        )
        .where("times > 0")
        .select("m_id", "m_body", "times")
        .groupBy("m_id", "m_body")
        .agg(F.max("times").alias("times"))
    )
    # Columns of the documents may have the names used here, so each is taken from its frame.
    same = documents["doc_id"].eqNullSafe(copies["m_id"]) & (
        F.xxhash64(documents["text"]) == copies["m_body"]
    )
    own = [documents[f"`{name}`"] for name in documents.columns]
    repeated = F.explode(F.sequence(F.lit(1), copies["times"])).alias("_mix_copy")
    return documents.join(copies, same).select(*own, repeated).drop("_mix_copy")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("body", "source_no", "shard")
