"""Documents whose sets of word shingles are similar, joined exactly and grouped.

Two documents link when ``100 * common >= 75 * union`` of their sets. Equal sets are one node
from the start. Nodes that cannot link are put aside by counting, without any pair:

1. In one order of all shingles (by hash) two sets that link have common shingles among the
   first of both: each set shows its first ``n - t + k`` shingles, t being the overlap that any
   link of it needs, and at least the smaller k of two linked sets are common there. Sets
   with fewer shown shingles that another set shows as well are alone.
2. For the others the number of sets that hold each shingle is counted. Now the rarest come
   first, and only the first ``n - t + 1`` of a set are its keys. What no other set holds is
   rarest and no key, so a passage that thousands of documents share is a key only of
   documents that have little else. Sets with a common key are in one coarse group.
3. Within a group T-occurrence search finds the links. A set's query goes over the inverted
   lists of its shingles: the L longest are put aside, the others are merged with a heap,
   and who is in T - L of them is looked up in the long lists by binary search (DivideSkip).
   Those that reach the overlap link.

Only links that join two parts of a group are kept, so groups of thousands of near copies
give a forest, never all pairs. While one part of a group holds most of it, its members need
no query: whoever is outside asks about all of them. Groups of more than ``BLOCK`` sets are cut
into blocks in the same spirit, see ``links_in_groups``.

Hot shingles: of all sets in a task that hold a shingle two are sent on, enough to know that
others hold it; the rest is counted where it is. Shuffles carry packed arrays by hash bucket.

Defined results: words are compared with A-Z lower-cased; a text of fewer than five words is
one shingle; null, empty and blank texts have no shingle and link with nothing. Rows with one
id are judged one by one and are reached separately. A null id is no smallest id: a component
of null ids only has a null id. Further columns are ignored; an empty table gives no rows.
Sets are told apart by 64-bit digests, shingles by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import (
    bounded_broadcast,
    collect_garbage,
    forget,
    give_back_memory,
    giving_back,
    ship,
    store,
    table,
)
from tillroll.llm.components import connected_components
from tillroll.llm.shingles import by_bucket, set_digest, shingle_set

SLICE = 1000
#: Shown shingles in a bucket, about.
BUCKET_ENTRIES = 1_000_000
#: The same for where keys meet, which are a quarter of all shingles at most, and the least.
MEETING_ENTRIES = 2_000_000
LEAST_MEETINGS = 16
#: Sets in a block of a large group, and shingles of all groups that go to one task, about.
BLOCK = 4096
TASK_SHINGLES = 2_000_000
BROADCAST_ROWS = 1_000_000
#: Lists with more members than this in all are merged by sorting instead of a heap.
HEAP_MEMBERS = 4000
NUM, DEN = 3, 4


def least_overlap(n: int) -> int:
    """Overlap that any link of a set of ``n`` needs."""
    return -(-NUM * n // DEN)


def least_common(n: int) -> int:
    """Shingles that a set of ``n`` shows in common with whatever it links to."""
    return max(1, least_overlap(n) // 8)


def shown(n: int) -> int:
    return n - least_overlap(n) + max(1, n // 8)


def pair_overlap(n: int, m: int) -> int:
    """Overlap at which sets of ``n`` and ``m`` link: 100 o >= 75 (n + m - o)."""
    return -(-NUM * (n + m) // (NUM + DEN))


def set_table(documents: DataFrame) -> DataFrame:
    """doc_id, hash of the text as ``body``, n_shingles and the digest of the set as ``node``
    (null without shingles)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py())
                sizes.append(len(shingles))
                nodes.append(set_digest(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("body"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                ],
                ["doc_id", "body", "n_shingles", "node"],
            )
        give_back_memory()

    return documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("body"), "text"
    ).mapInArrow(measure, "doc_id long, body long, n_shingles long, node long")


BLOCK_SCHEMA = "bucket int, nodes binary, owners binary, hashes binary"


def _block(bucket: int, nodes: np.ndarray, owners: np.ndarray, hashes: np.ndarray) -> tuple:
    """Hashes with their owners; a node is written once and owners are its places."""
    own, places = np.unique(owners, return_inverse=True)
    return (
        bucket,
        nodes[own].tobytes(),
        places.astype(np.uint16).tobytes(),  # at most SLICE nodes
        hashes.tobytes(),
    )


def _unblock(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All hashes and owners' nodes of a bucket."""
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for nodes, places, packed in zip(
        block.column("nodes"), block.column("owners"), block.column("hashes"), strict=True
    ):
        hashes.append(np.frombuffer(packed.as_py(), np.uint64))
        own = np.frombuffer(nodes.as_py(), np.int64)
        owners.append(own[np.frombuffer(places.as_py(), np.uint16)])
    return np.concatenate(hashes), np.concatenate(owners)


def _frame(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


BLOCK_NAMES = ["bucket", "nodes", "owners", "hashes"]
BLOCK_KINDS = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _holders(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each different (hash, owner), in that order, with the number of owners of the hash."""
    order = np.lexsort((owners, hashes))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])]
        hashes, owners = hashes[new], owners[new]
    _, counts = np.unique(hashes, return_counts=True)
    return hashes, owners, np.repeat(counts, counts)


def common_counts(documents: DataFrame, buckets: int) -> DataFrame:
    """node, count: for how many of the shown shingles some other set shows them too."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for at in range(0, large.num_rows, SLICE):
                sets: dict[int, np.ndarray] = {}
                for text in large.column("text").slice(at, SLICE):
                    found = shingle_set(text.as_py())
                    if len(found):
                        sets.setdefault(set_digest(found), found[: shown(len(found))])
                if not sets:
                    continue
                nodes = np.fromiter(sets, np.int64, len(sets))
                sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
                owners = np.repeat(np.arange(len(sets)), sizes)
                hashes, owners, held = _holders(np.concatenate(list(sets.values())), owners)
                # Two holders are enough to tell the others; the rest is counted here.
                place = np.arange(len(hashes)) - np.searchsorted(hashes, hashes)
                here, sent = place >= 2, place < 2
                rows = [
                    _block(bucket, nodes, o, h)
                    for bucket, (o, h) in by_bucket(
                        (hashes[sent] % np.uint64(buckets)).astype(np.int32),
                        owners[sent],
                        hashes[sent],
                    )
                ]
                known = np.bincount(owners[here], minlength=len(nodes))
                some = np.flatnonzero(known)
                if len(some):
                    counted = known[some].astype(np.uint32).tobytes()
                    rows.append((int(nodes[0] % buckets), nodes[some].tobytes(), counted, None))
                yield _frame(rows, BLOCK_NAMES, BLOCK_KINDS)
        give_back_memory()

    @giving_back
    def count(block: pa.Table) -> pa.Table:
        counted = pc.is_null(block.column("hashes"))
        hashes, owners = _unblock(block.filter(pc.invert(counted)))
        hashes, owners, held = _holders(hashes, owners)
        nodes, counts = np.unique(owners[held > 1], return_counts=True)
        nodes, counts = [nodes], [counts]
        for ready in block.filter(counted).to_pylist():
            nodes.append(np.frombuffer(ready["nodes"], np.int64))
            counts.append(np.frombuffer(ready["owners"], np.uint32))
        return pa.table(
            {
                "node": np.concatenate(nodes).astype(np.int64),
                "count": np.concatenate(counts).astype(np.int64),
            }
        )

    dealt = documents.select("text").mapInArrow(deal, BLOCK_SCHEMA)
    counts = dealt.groupBy("bucket").applyInArrow(count, "node long, count long")
    return counts.groupBy("node").agg(F.sum("count").alias("count"))


def live_sets(documents: DataFrame, live: DataFrame) -> DataFrame:
    """node and packed shingles of the sets in ``live`` (doc_id of one holder, node)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text in zip(batch.column("node"), batch.column("text"), strict=True):
                found = shingle_set(text.as_py())
                # Another row with the same id may have another text.
                if len(found) and set_digest(found) == node.as_py():
                    rows.append((node.as_py(), found.tobytes()))
            yield _frame(rows, ["node", "shingles"], [pa.int64(), pa.binary()])
        give_back_memory()

    held = bounded_broadcast(live.select(F.col("doc_id").alias("holder"), "node"), BROADCAST_ROWS)
    return (
        documents.select(F.col("doc_id").cast("long"), "text")
        .join(held, F.col("doc_id").eqNullSafe(F.col("holder")))
        .select("node", "text")
        .mapInArrow(pack, "node long, shingles binary")
    )


KEY_SCHEMA = "bucket int, nodes binary, owners binary, hashes binary, held binary"


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edges that join the same nodes as all (a, b) do, fewer than there are nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    kept = []
    pairs = np.unique(np.stack([a, b], 1).astype(np.int64), axis=0)
    for x, y in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
        one, other = root(x), root(y)
        if one != other:
            parent[max(one, other)] = min(one, other)
            kept.append((x, y))
    return np.array(kept, np.int64).reshape(-1, 2)


def coarse_edges(sets: DataFrame, buckets: int, meetings: int) -> DataFrame:
    """a, b: sets that share a key, each with one of those that share it.

    Keys meet in fewer buckets than shingles: a bucket returns what hangs together in it, and
    few buckets return few copies of one edge."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for at in range(0, large.num_rows, SLICE):
                batch = large.slice(at, SLICE)
                nodes = batch.column("node").to_numpy()
                packed = [np.frombuffer(s.as_py(), np.uint64) for s in batch.column("shingles")]
                hashes = np.concatenate(packed)
                owners = np.repeat(np.arange(len(nodes)), [len(p) for p in packed])
                yield _frame(
                    [
                        _block(bucket, nodes, o, h)
                        for bucket, (o, h) in by_bucket(
                            (hashes % np.uint64(buckets)).astype(np.int32), owners, hashes
                        )
                    ],
                    BLOCK_NAMES,
                    BLOCK_KINDS,
                )
        give_back_memory()

    @giving_back
    def count(block: pa.Table) -> pa.Table:
        """Shared shingles go to their owner's bucket with the number of sets that hold them."""
        hashes, owners, held = _holders(*_unblock(block))
        several = held > 1
        hashes, owners, held = hashes[several], owners[several], held[several]
        rows = [
            (bucket, o.tobytes(), None, h.tobytes(), n.astype(np.uint32).tobytes())
            for bucket, (o, h, n) in by_bucket(
                (owners.view(np.uint64) % np.uint64(buckets)).astype(np.int32),
                owners,
                hashes,
                held,
            )
        ]
        return pa.Table.from_batches(
            [_frame(rows, [*BLOCK_NAMES, "held"], [*BLOCK_KINDS, pa.binary()])]
        )

    @giving_back
    def order(block: pa.Table) -> pa.Table:
        """The keys of every set: the rarest of those that others hold, after what none does."""
        sizes = [r for r in block.to_pylist() if r["held"] is None]
        parts = [r for r in block.to_pylist() if r["held"] is not None]
        empty = [np.empty(0, np.int64)]
        size_of = dict(
            zip(
                np.concatenate(empty + [np.frombuffer(r["nodes"], np.int64) for r in sizes]).tolist(),
                np.concatenate(empty + [np.frombuffer(r["owners"], np.uint32) for r in sizes]).tolist(),
                strict=True,
            )
        )
        owners = np.concatenate(empty + [np.frombuffer(r["nodes"], np.int64) for r in parts])
        hashes = np.concatenate(
            [np.empty(0, np.uint64)] + [np.frombuffer(r["hashes"], np.uint64) for r in parts]
        )
        held = np.concatenate(
            [np.empty(0, np.uint32)] + [np.frombuffer(r["held"], np.uint32) for r in parts]
        )
        ordered = np.lexsort((hashes, held, owners))
        owners, hashes = owners[ordered], hashes[ordered]
        own, first, counts = np.unique(owners, return_index=True, return_counts=True)
        place = np.arange(len(owners)) - np.repeat(first, counts)
        size = np.array([size_of[o] for o in own.tolist()], np.int64)
        need = -(-NUM * size // DEN)
        # n - t + 1 come first, of which the n - counts that nobody else holds are no keys.
        keys = place < np.repeat(counts - need + 1, counts)
        owners, hashes = owners[keys], hashes[keys]
        # Owners that meet here hang together here; one of them goes on for all.
        near, back = np.unique(hashes, return_inverse=True)
        least = np.full(len(near), np.iinfo(np.int64).max)
        np.minimum.at(least, back, owners)
        edges = _forest(owners, least[back])
        rows = [(-1, edges.tobytes(), None, None, None)] if len(edges) else []
        rows += [
            (bucket, n.tobytes(), None, h.tobytes(), None)
            for bucket, (n, h) in by_bucket(
                (near % np.uint64(meetings)).astype(np.int32), least, near
            )
        ]
        return pa.Table.from_batches(
            [_frame(rows, [*BLOCK_NAMES, "held"], [*BLOCK_KINDS, pa.binary()])]
        )

    @giving_back
    def join(block: pa.Table) -> pa.Table:
        edges = [np.empty((0, 2), np.int64)]
        nodes, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for row in block.to_pylist():
            if row["hashes"] is None:
                edges.append(np.frombuffer(row["nodes"], np.int64).reshape(-1, 2))
            else:
                nodes.append(np.frombuffer(row["nodes"], np.int64))
                hashes.append(np.frombuffer(row["hashes"], np.uint64))
        nodes, hashes = np.concatenate(nodes), np.concatenate(hashes)
        keys, back = np.unique(hashes, return_inverse=True)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(least, back, nodes)
        edges.append(np.stack([nodes, least[back]], 1))
        found = _forest(*np.concatenate(edges).T)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            n = np.array([len(s.as_py()) // 8 for s in batch.column("shingles")], np.uint32)
            rows = [
                (bucket, o.tobytes(), m.tobytes(), None, None)
                for bucket, (o, m) in by_bucket(
                    (nodes.view(np.uint64) % np.uint64(buckets)).astype(np.int32), nodes, n
                )
            ]
            yield _frame(rows, [*BLOCK_NAMES, "held"], [*BLOCK_KINDS, pa.binary()])

    counted = sets.mapInArrow(deal, BLOCK_SCHEMA).groupBy("bucket").applyInArrow(count, KEY_SCHEMA)
    with_sizes = counted.unionByName(sets.mapInArrow(sizes, KEY_SCHEMA))
    keys = with_sizes.groupBy("bucket").applyInArrow(order, KEY_SCHEMA)
    # Edges found already are dealt out evenly; keys meet by bucket.
    spread = F.when(
        F.col("bucket") < 0, F.pmod(F.hash("nodes"), F.lit(meetings))
    ).otherwise(F.col("bucket"))
    return (
        keys.withColumn("bucket", spread.cast("int"))
        .groupBy("bucket")
        .applyInArrow(join, "a long, b long")
        .where("a <> b")
        .distinct()
    )


class InvertedLists:
    """Ascending places of the sets that hold each shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.owners = owners[order]
        shingles, self.starts, self.lengths = np.unique(
            every[order], return_index=True, return_counts=True
        )
        lists = np.searchsorted(shingles, every)
        self.lists = np.split(lists, np.cumsum(self.sizes)[:-1])

    def _list(self, number: int) -> np.ndarray:
        start = self.starts[number]
        return self.owners[start : start + self.lengths[number]]

    def links(self, query: int) -> np.ndarray:
        """Places of all sets that link with ``query``, itself among them (DivideSkip)."""
        n = int(self.sizes[query])
        need = least_overlap(n)
        numbers = self.lists[query]
        numbers = numbers[np.argsort(self.lengths[numbers], kind="stable")]
        longest = int(self.lengths[numbers[-1]])
        # As many long lists as pay: looking up costs a logarithm, merging every member.
        long = min(need - 1, int(need / (0.01 * math.log2(longest + 1) + 1)))
        short, probed = numbers[: len(numbers) - long], numbers[len(numbers) - long :]
        places, counts = self._merge([self._list(i) for i in short])
        alive = counts >= need - long
        sizes = self.sizes[places]
        # Other sizes cannot reach the overlap at all.
        alive &= (NUM * n <= DEN * sizes) & (NUM * sizes <= DEN * n)
        places, counts = places[alive], counts[alive]
        wanted = -(-NUM * (self.sizes[places] + n) // (NUM + DEN))
        left = len(probed)
        for number in probed:
            if not len(places):
                break
            members = self._list(number)
            at = np.searchsorted(members, places)
            at[at == len(members)] = 0
            counts = counts + (members[at] == places)
            left -= 1
            hope = counts + left >= wanted
            if not hope.all():
                places, counts, wanted = places[hope], counts[hope], wanted[hope]
        return places[counts >= wanted]

    @staticmethod
    def _merge(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The different members of sorted lists, and in how many lists each is."""
        if sum(map(len, lists)) <= HEAP_MEMBERS:
            merged = np.fromiter(heapq.merge(*(x.tolist() for x in lists)), np.int64)
        else:
            merged = np.sort(np.concatenate(lists), kind="stable")
        starts = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]])
        return merged[starts], np.diff(np.r_[starts, len(merged)])


def group_links(sets: list[np.ndarray], asking: list[int] | None = None) -> list[tuple[int, int]]:
    """A forest over the places of ``sets`` that joins just what links join; with ``asking`` only
    what links of these places join."""
    index = InvertedLists(sets)
    parent = list(range(len(sets)))
    size = [1] * len(sets)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest, main = [], 0
    waiting, spared = deque(range(len(sets)) if asking is None else asking), []
    while waiting:
        query = waiting.popleft()
        # Whoever is outside the largest part asks about all, so its members need not.
        if asking is None and query != main and root(query) == root(main):
            spared.append(query)
            continue
        for other in index.links(query).tolist():
            a, b = root(query), root(other)
            if a != b:
                if size[a] < size[b]:
                    a, b = b, a
                parent[b] = a
                size[a] += size[b]
                forest.append((query, other))
        if asking is None and size[root(query)] > size[root(main)]:
            # Another part is the largest now: members of the former one have to ask.
            waiting.extend(spared)
            main, spared = query, []
    return forest


def links_in_groups(
    sets: DataFrame, groups: DataFrame, tasks: int, block: int = BLOCK
) -> DataFrame:
    """a, b: links that join what is similar within each group (node, label) of sets.

    A group of more than ``block`` sets is cut into blocks of half of that. First every block
    meets the first one, in a task of its own. That finds all links inside a block and with the
    first; in a group of near copies nearly all sets hang together then. Only links that join
    different parts are missing, and one end of those is outside the largest part. So those
    outside ask about all others: in chunks of half a block they go to every block. A set is
    copied as often as there are such chunks, not as there are blocks."""
    large = store(
        groups.groupBy("label")
        .agg(F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > block)
        .select(
            F.col("label").alias("large"), F.ceil(2 * F.col("members") / block).alias("blocks")
        ),
        "large-groups",
    )
    placed = groups.join(
        bounded_broadcast(large, BROADCAST_ROWS), F.col("label") == F.col("large"), "left"
    ).withColumn("own", F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))))
    others = F.when(
        (F.col("own") == 0) & F.col("blocks").isNotNull(),
        F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1),
    ).otherwise(F.array("own"))
    first = placed.withColumn("other", F.explode(others)).select(
        "node", F.xxhash64("label", "other").alias("search"), F.lit(True).alias("asks")
    )
    found = store(_search(sets, first, tasks), "links")
    if large.isEmpty():
        forget(sets.sparkSession, large)
        return found

    members = placed.where("blocks IS NOT NULL")
    hanging = connected_components(found).withColumnRenamed("label", "hangs")
    parts = store(
        members.join(hanging, "node", "left").withColumn("part", F.coalesce("hangs", "node")),
        "parts",
    )
    main = (
        parts.groupBy("label", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("label")
        .agg(F.max(F.struct("n", "part")).alias("main"))
        .select("label", F.col("main.part").alias("main"))
    )
    outside = parts.join(main, "label").where(F.col("part") != F.col("main"))
    chunks = store(
        outside.groupBy("label").agg(F.ceil(2 * F.count(F.lit(1)) / block).alias("chunks")),
        "chunks",
    )
    chunk = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("chunks"))
    asking = (
        outside.join(chunks, "label")
        .withColumn("chunk", chunk)
        .withColumn("own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("node", "label", "chunk", "own", F.lit(True).alias("asks"))
    )
    asked = (
        parts.join(chunks, "label")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("node", "label", "chunk", "own", F.lit(False).alias("asks"))
    )
    second = asking.unionByName(asked).select(
        "node", F.xxhash64("label", "chunk", "own").alias("search"), "asks"
    )
    more = store(_search(sets, second, tasks), "links")
    return found.unionByName(more)


def _search(sets: DataFrame, dealt: DataFrame, tasks: int) -> DataFrame:
    """a, b: what joins the sets (node, search, asks) that are in one search, as far as those
    that ask are linked; several searches in a task."""

    @giving_back
    def search(task: pa.Table) -> pa.Table:
        searches: dict[int, dict[int, np.ndarray]] = {}
        asking: dict[int, set[int]] = {}
        for search, node, asks, packed in zip(
            *(task.column(c).to_pylist() for c in ("search", "node", "asks")),
            task.column("shingles"),
            strict=True,
        ):
            searches.setdefault(search, {})[node] = np.frombuffer(packed.as_py(), np.uint64)
            if asks:
                asking.setdefault(search, set()).add(node)
        found = []
        for key, members in searches.items():
            nodes = sorted(members)
            who = [i for i, node in enumerate(nodes) if node in asking.get(key, ())]
            if len(nodes) > 1 and who:
                every = None if len(who) == len(nodes) else who
                for x, y in group_links([members[n] for n in nodes], every):
                    found.append((nodes[x], nodes[y]))
        return pa.Table.from_batches([_frame(found, ["a", "b"], [pa.int64(), pa.int64()])])

    return (
        sets.join(dealt, "node")
        .select(
            F.pmod("search", F.lit(tasks)).alias("task"), "search", "asks", "node", "shingles"
        )
        .groupBy("task")
        .applyInArrow(search, "a long, b long")
    )


def similar_documents(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id it is linked with."""
    placed, smallest = similar_rows(documents, block)
    return placed.join(smallest, "part", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("part").isNull(), F.col("doc_id"))
        .otherwise(F.col("smallest"))
        .alias("component_id"),
    )


def similar_rows(documents: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Per row doc_id, ``body`` (hash of the text), n_shingles and ``part``, a number of its
    component that is null without shingles; and per part the ``smallest`` doc_id and the
    ``first`` row, by id and body, null last."""
    spark = documents.sparkSession
    ship(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    measured = store(set_table(documents), "sets")
    shingles = measured.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(partitions, math.ceil(0.375 * shingles / BUCKET_ENTRIES))

    common = common_counts(documents, buckets)
    holders = (
        measured.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"))
    )
    least = F.greatest(F.floor(F.floor((NUM * F.col("n") + DEN - 1) / DEN) / 8), F.lit(1))
    live = store(
        holders.join(common, "node").where(F.col("count") >= least).select("doc_id", "node", "n"),
        "live",
    )
    sets = store(live_sets(documents, live), "live-sets")
    collect_garbage(spark)
    kept = live.agg(F.sum("n")).first()[0] or 0
    edges = coarse_edges(
        sets,
        max(partitions, math.ceil(kept / BUCKET_ENTRIES)),
        max(LEAST_MEETINGS, math.ceil(kept / MEETING_ENTRIES)),
    )
    groups = connected_components(edges)
    tasks = max(partitions, math.ceil(kept / TASK_SHINGLES))
    parts = connected_components(links_in_groups(sets, groups, tasks, block))

    placed = measured.join(parts, "node", "left").select(
        "doc_id", "body", "n_shingles", F.coalesce("label", "node").alias("part")
    )
    placed = store(placed, "placed")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "body")
    # Stored, so that the join deals both sides anew and can split a hot component.
    smallest = store(
        placed.where("part IS NOT NULL")
        .groupBy("part")
        .agg(F.min("doc_id").alias("smallest"), F.min(row).alias("first")),
        "smallest",
    )
    forget(spark, measured, live, sets, groups, parts)
    collect_garbage(spark)
    return placed, smallest


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))
