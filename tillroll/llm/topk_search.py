"""Exact k nearest vectors by integer inner product, with M-trees searched best first.

An inner product is no metric, so every vector gets one more coordinate that brings all of
them to the length of the longest; queries get 0 there. Then a larger product is a smaller
distance, and an M-tree can prune by the triangle inequality. Its nodes are pages: a leaf has
vectors with their distances to the page's centre, an inner page has children with centre,
covering radius and distance to the centre above. The search takes the page with the smallest
possible distance first and stops when none can hold a better vector. What the stored
distances already rule out is never compared with the query.

On Spark the vectors go to the nearest of at most ``PIVOTS`` routing vectors, a bounded sample
by hash; every vector is indexed. A crowded pivot is cut into pieces by hash of the id, so a
vector that a third of all rows repeat is many trees. A query's k best in the sample bound its
distance before any tree is searched, and it goes to no pivot whose covering radius rules it
out. The vectors of a piece and then its queries come to one task in this order, sorted, so a
tree is built once, however many queries there are, and they stream past it in batches; no vector
and no query of a piece is copied. Each tree returns at most k rows for a query. Scores are
computed on the integers, so the pruned distances need only be safe, and they get a margin for
rounding.

Defined results: vectors that are null, empty or hold null or non-finite components take no
part, nor do rows without id. Rows are told apart even where they share an id: each is a
candidate, and a query if its id is divisible, for which all rows but itself count. Shorter
vectors are filled up with 0. Ties go to the smaller id. With fewer than k others all are returned.
Components are 64-bit after scaling and scores 64-bit. Further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import forget, ship, store, table

K = 5
SCALE = 256
EVERY = 50
PIVOTS = 256
TREE_ROWS = 8192
PAGE = 512
FAN = 64


@dataclass
class Page:
    centre: np.ndarray
    radius: float = 0.0
    #: Distances of the entries to the centre, and in a leaf the entries themselves.
    distances: np.ndarray = field(default_factory=lambda: np.empty(0))
    vectors: np.ndarray | None = None
    ids: np.ndarray | None = None
    rows: np.ndarray | None = None
    children: list[Page] = field(default_factory=list)


class MTree:
    """Over integer vectors; ``length`` is that of the longest vector of all trees. ``rows`` tell
    the entries apart where ids do not."""

    def __init__(
        self,
        ids: np.ndarray,
        vectors: np.ndarray,
        length: float,
        rows: np.ndarray | None = None,
    ):
        rows = ids if rows is None else rows
        order = np.lexsort((rows, ids))
        self.ids, self.vectors, self.rows = ids[order], vectors[order], rows[order]
        norms = (self.vectors.astype(float) ** 2).sum(1)
        last = np.sqrt(np.maximum(length**2 - norms, 0))
        self.points = np.c_[self.vectors.astype(float), last]
        self.margin = 1e-6 * (1 + length)
        # Doubles hold products below 2^52 exactly, and are multiplied much faster.
        self.exact = float if length**2 < 2**52 else np.int64
        self.computed = 0
        self.root = self._page(np.arange(len(ids)))

    def _page(self, rows: np.ndarray) -> Page:
        points = self.points[rows]
        centre = points.mean(0)
        page = Page(centre)
        if len(rows) <= PAGE:
            page.vectors = self.vectors[rows].astype(self.exact)
            page.ids, page.rows = self.ids[rows], self.rows[rows]
            page.distances = np.sqrt(((points - centre) ** 2).sum(1))
            page.radius = float(page.distances.max())
            return page
        # Routing points lie evenly in the order of ids, which makes children of like sizes.
        near = np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), int)
        fan = min(FAN, math.ceil(2 * len(rows) / PAGE))
        for number, place in enumerate(np.linspace(0, len(rows) - 1, fan).astype(int)):
            away = ((points - points[place]) ** 2).sum(1)
            owner[away < near] = number
            near = np.minimum(near, away)
        parts = [rows[owner == n] for n in range(fan)]
        if max(map(len, parts)) == len(rows):  # equal vectors: pages in order of id
            parts = np.array_split(rows, math.ceil(len(rows) / PAGE))
        page.children = [self._page(part) for part in parts if len(part)]
        centres = np.array([c.centre for c in page.children])
        page.distances = np.sqrt(((centres - centre) ** 2).sum(1))
        page.radius = float(np.sqrt(((points - centre) ** 2).sum(1)).max())
        return page

    def nearest(
        self, query: np.ndarray, own: int, k: int, bound: float = math.inf
    ) -> list[tuple[int, int]]:
        """The k best (score, id) but the query's own row, best first; ``bound`` is a distance
        within which k others are known to be."""
        return [(score, name) for score, name, _ in self.nearest_rows(query, own, k, bound)]

    def nearest_rows(
        self, query: np.ndarray, own: int, k: int, bound: float = math.inf
    ) -> list[tuple[int, int, int]]:
        """As ``nearest``, with the row of each: (score, id, row)."""
        point = np.r_[query.astype(float), 0.0]
        length = self.points[0] @ self.points[0] + point @ point
        margin = self.margin + 1e-6 * math.sqrt(point @ point)
        exact = query.astype(self.exact)
        best: list[tuple[int, int, int]] = []  # a heap, the worst first: (score, -id, -row)
        limit = bound + margin
        to_root = math.sqrt(((self.root.centre - point) ** 2).sum())
        waiting = [(max(0.0, to_root - self.root.radius), 0, to_root, self.root)]
        number = 0
        while waiting:
            least, _, to_centre, page = heapq.heappop(waiting)
            if least > limit:
                break
            if page.vectors is None:
                radii = np.array([c.radius for c in page.children])
                may = np.flatnonzero(np.abs(page.distances - to_centre) - radii <= limit)
                for i in may:
                    child = page.children[i]
                    away = math.sqrt(((child.centre - point) ** 2).sum())
                    if away - child.radius <= limit:
                        number += 1
                        heapq.heappush(
                            waiting, (max(0.0, away - child.radius), number, away, child)
                        )
                continue
            vectors, ids, rows = page.vectors, page.ids, page.rows
            may = np.abs(page.distances - to_centre) <= limit
            if not may.all():
                vectors, ids, rows = vectors[may], ids[may], rows[may]
            self.computed += len(ids)
            scores = vectors @ exact
            if len(best) == k:  # only what can still enter
                enter = np.flatnonzero(scores >= best[0][0])
                scores, ids, rows = scores[enter], ids[enter], rows[enter]
            first = np.lexsort((rows, ids, -scores))[: k + 1]
            for score, other, row in zip(
                scores[first].tolist(), ids[first].tolist(), rows[first].tolist(), strict=True
            ):
                if row == own:
                    continue
                entry = (int(score), -other, -row)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                limit = min(limit, math.sqrt(max(0.0, length - 2 * best[0][0])) + margin)
        return [(score, -other, -row) for score, other, row in sorted(best, reverse=True)]


def clean_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """row (a number of its own), vec_id, vector: usable rows with components
    ``floor(scale * x)``."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(
        "embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")
    )
    usable = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite
    return embeddings.where(usable).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        whole.alias("vector"),
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def top_k(
    embeddings: DataFrame,
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
    pivots_at_most: int = PIVOTS,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best others of each id divisible by ``every``."""
    spark = embeddings.sparkSession
    ship(spark)
    vectors = store(clean_vectors(embeddings, scale), "vectors")
    squares = F.aggregate(
        F.transform("vector", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, b: a + b
    )
    count, square, width = vectors.agg(
        F.count(F.lit(1)), F.max(squares), F.max(F.size("vector"))
    ).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    length = math.sqrt(square)
    sample = vectors.orderBy(F.xxhash64("row"), "row").limit(pivots_at_most).collect()
    known_rows = np.array([r["row"] for r in sample])
    known = np.zeros((len(sample), width), np.int64)
    for i, row in enumerate(sample):
        known[i, : len(row["vector"])] = row["vector"]
    n_pivots = min(len(sample), max(1, math.ceil(count / tree_rows)))

    def lift(rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(float)
        return np.c_[rows, np.sqrt(np.maximum(length**2 - (rows**2).sum(1), 0))]

    pivots = lift(known[:n_pivots])

    def apart(points: np.ndarray) -> np.ndarray:
        squared = (
            (points**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * points @ pivots.T
        )
        return np.sqrt(np.maximum(squared, 0))

    def route(batches):
        for batch in batches:
            away = apart(lift(_matrix(batch.column("vector"), width)))
            pivot = away.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "vec_id", "vector")),
                    pa.array(pivot.astype(np.int32)),
                    pa.array(away[np.arange(len(pivot)), pivot]),
                ],
                ["row", "vec_id", "vector", "pivot", "away"],
            )

    routed = store(
        vectors.mapInArrow(
            route, "row long, vec_id long, vector array<long>, pivot int, away double"
        ),
        "routed",
    )
    # One row for each pivot.
    cover = {
        r["pivot"]: (r["radius"], max(1, math.ceil(r["rows"] / tree_rows)))
        for r in routed.groupBy("pivot")
        .agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("rows"))
        .collect()
    }
    asking = vectors.where(F.col("vec_id") % every == 0)
    counts = [cover.get(p, (0, 1))[1] for p in range(n_pivots)]
    pieces = F.element_at(F.array(*map(F.lit, counts)), F.col("pivot") + 1)
    trees = routed.select(
        "pivot",
        F.pmod(F.xxhash64("row"), pieces).cast("int").alias("piece"),
        F.lit(False).alias("asks"),
        "row",
        "vec_id",
        "vector",
        F.lit(None).cast("double").alias("bound"),
    )

    def ask(batches):
        slack = 1e-6 * (1 + length)
        radii = np.array([cover.get(p, (-math.inf, 0))[0] for p in range(n_pivots)])
        for batch in batches:
            queries = _matrix(batch.column("vector"), width)
            rows = batch.column("row").to_numpy()
            scores = queries @ known.T
            scores[known_rows == rows[:, None]] = np.iinfo(np.int64).min
            floats = queries.astype(float)
            norms = (floats**2).sum(1)
            if len(known_rows) > k:
                worst = -np.partition(-scores, k - 1, axis=1)[:, k - 1].astype(float)
                bound = np.sqrt(np.maximum(norms + length**2 - 2 * worst, 0))
            else:
                bound = np.full(len(rows), math.inf)
            away = apart(np.c_[floats, np.zeros(len(rows))])
            reach = away - radii <= (bound + slack + 1e-6 * np.sqrt(norms))[:, None]
            who, where = np.nonzero(reach)
            taken = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(where.astype(np.int32)),
                    *(batch.column(c).take(taken) for c in ("row", "vec_id", "vector")),
                    pa.array(bound[who]),
                ],
                ["pivot", "row", "vec_id", "vector", "bound"],
            )

    asked = (
        asking.mapInArrow(
            ask, "pivot int, row long, vec_id long, vector array<long>, bound double"
        )
        .withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .withColumn("asks", F.lit(True))
    )
    # In each task one tree after another: first its vectors, then the queries that go to it.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts))
    dealt = (
        trees.unionByName(asked)
        .repartition(tasks, "pivot", "piece")
        .sortWithinPartitions("pivot", "piece", "asks", "row")
    )

    def search(batches):
        here, waiting, tree = None, [], None
        for batch in batches:
            kinds = np.stack(
                [
                    batch.column("pivot").to_numpy(),
                    batch.column("piece").to_numpy(),
                    batch.column("asks").to_numpy(zero_copy_only=False),
                ],
                1,
            )
            starts = np.flatnonzero(np.r_[True, (kinds[1:] != kinds[:-1]).any(1)])
            out = {name: [] for name in ("query", "query_id", "vec_id", "row", "score")}
            for start, stop in zip(starts, [*starts[1:], len(kinds)], strict=True):
                *place, asks = kinds[start].tolist()
                part = batch.slice(start, stop - start)
                if place != here:
                    here, waiting, tree = place, [], None
                if not asks:
                    waiting.append(part)
                    continue
                if tree is None and waiting:
                    held = pa.Table.from_batches(waiting)
                    tree = MTree(
                        held.column("vec_id").to_numpy(),
                        _matrix(held.column("vector"), width),
                        length,
                        held.column("row").to_numpy(),
                    )
                    waiting = []
                if tree is None:
                    continue
                for query, own, name, bound in zip(
                    _matrix(part.column("vector"), width),
                    *(part.column(c).to_pylist() for c in ("row", "vec_id", "bound")),
                    strict=True,
                ):
                    for score, other, row in tree.nearest_rows(query, own, k, bound):
                        for column, value in zip(
                            out.values(), (own, name, other, row, score), strict=True
                        ):
                            column.append(value)
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})

    found = dealt.mapInArrow(
        search, "query long, query_id long, vec_id long, row long, score long"
    )
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    result = (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
    result = store(result, "top-k")
    forget(spark, vectors, routed)
    return result


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP6_SQL = f"""
WITH usable AS (
  SELECT row_number() OVER () AS line, vec_id, list_transform(embedding,
           lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.line AS query, q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % {EVERY} = 0 AND c.line <> q.line),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
