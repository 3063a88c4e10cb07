"""Exact top-k inner products by best-first search in M-trees.

Vectors become whole numbers, floor(256 * x). With the largest norm M of all vectors, x' = (x, sqrt(M^2 - |x|^2)) and
q' = (q, 0) turn the largest inner product into the smallest distance, and distances obey the triangle inequality.
Vectors are dealt to the nearest of a few pivots, and each pivot's to pages of bounded size; a page is an M-tree whose
nodes know their centre, covering radius, and distance to the parent's centre. A query opens a page's nodes in the order
of their least possible distance and leaves those that cannot beat its k-th best; the stored parent distances rule
entries out before their own distance is computed. Scores are whole numbers, so the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqloom.operators.staging import stage

SCALE = 256
K = 5
PAGE = 4096
LEAF = 256
FAN = 16
#: The sample of vectors that serve as pivots, and the queries in a block.
PIVOTS = 64
QUERIES = 1024
SPREAD = 16
#: Distances are floats: bounds are loosened by this much, so that rounding hides nothing.
SLACK = 1e-6
#: Products below this are exact; no product of two vectors is larger than the largest squared length.
EXACT = 2.0**53


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """`vec_id` and `v`, floor(256 x) of each component; vectors null, or holding a null or non-finite number, are left out."""
    x = F.col(f"`{column}`").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), x.alias("x"), bad.alias("bad"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~F.coalesce("bad", F.lit(True)))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("long")).alias("v"))


class Tree:
    """An M-tree over the rows of `points`: nodes in arrays, children and points of a node side by side."""

    def __init__(self, points: np.ndarray) -> None:
        self.order, self.point_parent = np.arange(len(points)), np.zeros(len(points))
        self.nodes: list[tuple] = []  # centre row, radius, distance to parent, first, last, leaf
        self.points = points
        middle = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1))) if len(points) else 0
        pending = [(0, len(points), middle, 0.0, self._new())]
        while pending:
            pending += self._grow(*pending.pop())

    def _new(self) -> int:
        self.nodes.append(())
        return len(self.nodes) - 1

    def _grow(self, first: int, last: int, centre: int, to_parent: float, at: int) -> list[tuple]:
        rows = self.order[first:last]
        away = np.sqrt(((self.points[rows] - self.points[centre]) ** 2).sum(axis=1))
        radius = float(away.max(initial=0.0))
        if last - first <= LEAF:
            self.point_parent[first:last] = away
            self.nodes[at] = (centre, radius, to_parent, first, last, True)
            return []
        # routing points: farthest first; equal points are dealt into slices instead
        chosen, least = [int(np.argmax(away))], None
        while len(chosen) < FAN:
            gap = ((self.points[rows] - self.points[rows[chosen[-1]]]) ** 2).sum(axis=1)
            least = gap if least is None else np.minimum(least, gap)
            chosen.append(int(np.argmax(least)))
        gaps = np.stack([((self.points[rows] - self.points[rows[c]]) ** 2).sum(axis=1) for c in chosen])
        part = gaps.argmin(axis=0) if radius > 0 else np.arange(len(rows)) * FAN // len(rows)
        by = np.argsort(part, kind="stable")
        self.order[first:last] = rows[by]
        sizes = np.bincount(part, minlength=FAN)
        children, start, low = [], first, len(self.nodes)
        for c, size in zip(chosen, sizes):
            if size:
                to = float(np.sqrt(((self.points[rows[c]] - self.points[centre]) ** 2).sum()))
                children.append((start, start + int(size), int(rows[c]), to, self._new()))
                start += int(size)
        self.nodes[at] = (centre, radius, to_parent, low, len(self.nodes), False)
        return children


def search(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, tree: tuple, k: int, floor: float | None) -> list[tuple[float, int]]:
    """Up to k (score, id) of the page's best for one query, its own row left out; `floor` is a score that k rows reach.

    Vectors and query are whole numbers held as floats, so that products stay exact below 2^53.
    """
    centre, radius, to_parent, first, last, leaf, point_parent = tree
    lifted = np.append(query, 0.0)
    norm = float(lifted @ lifted) + float(points[0] @ points[0])  # |q|^2 + M^2: all lifted points have length M
    best: list[tuple[float, int]] = []  # heap of (score, -id), worst first

    def reach() -> float:
        """The largest distance that can still matter."""
        worst = best[0][0] if len(best) == k else None
        worst = floor if worst is None else worst if floor is None else max(worst, floor)
        return np.inf if worst is None else np.sqrt(max(norm - 2.0 * worst, 0.0)) + SLACK

    to_root = float(np.sqrt(((lifted - points[centre[0]]) ** 2).sum()))
    queue = [(max(to_root - radius[0], 0.0), 0, to_root)]
    while queue:
        bound, node, to_centre = heapq.heappop(queue)
        limit = reach()
        if bound > limit:
            break
        low, high = first[node], last[node]
        if leaf[node]:
            near = low + np.flatnonzero(np.abs(to_centre - point_parent[low:high]) <= limit)
            scores = vectors[near] @ query
            worst = best[0][0] if len(best) == k else -np.inf
            high = np.flatnonzero(scores >= max(worst, -np.inf if floor is None else floor))
            for score, vec in zip(scores[high].tolist(), ids[near[high]].tolist()):
                if vec != own:
                    if len(best) < k:
                        heapq.heappush(best, (score, -vec))
                    elif (score, -vec) > best[0]:
                        heapq.heapreplace(best, (score, -vec))
            continue
        near = low + np.flatnonzero(np.abs(to_centre - to_parent[low:high]) - radius[low:high] <= limit)
        away = np.sqrt(((points[centre[near]] - lifted) ** 2).sum(axis=1))
        for child, distance in zip(near.tolist(), away.tolist()):
            if distance - radius[child] <= limit:
                heapq.heappush(queue, (max(distance - radius[child], 0.0), child, distance))
    return [(score, -vec) for score, vec in best]


def top_k(vectors: DataFrame, is_query, k: int = K, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest integer inner products with rows of other ids.

    `is_query` is a condition on `vec_id`. Ties go to the smaller id; a query with fewer candidates returns all. Vectors
    null, or holding a null or a non-finite component, and rows without id take no part. Rows that repeat an id are
    candidates each, but never for a query of that id; as queries, all their products are ranked together. Vectors need one
    length, and a squared length below 2^53, or the search raises. An empty table gives an empty one.

    Queries are packed into blocks of at most QUERIES and meet every page of at most about PAGE vectors; a page that its
    covering radius rules out costs one distance. Only the pivots, at most PIVOTS vectors, are in every task.
    """
    rows = stage(whole_vectors(vectors, id_column, column))
    squares = F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    total, longest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(squares), F.lit(0.0))).first()
    if longest >= EXACT:
        raise ValueError("products of these vectors reach 2^53, where they are no longer exact")
    longest = int(longest)
    wanted = max(1, min(PIVOTS, total // PAGE))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
    pivots = np.array([row.v for row in sample], dtype=np.int64) if sample else np.zeros((1, 1), np.int64)
    pivot_ids = np.array([row.vec_id for row in sample], dtype=np.int64)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("v"))
                gaps = (v * v).sum(axis=1)[:, None] - 2 * v @ pivots.T + (pivots * pivots).sum(axis=1)[None, :]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(gaps.argmin(axis=1).astype(np.int32))], names=["vec_id", "v", "pivot"])

    near = stage(rows.mapInArrow(nearest, "vec_id long, v array<long>, pivot int"))
    sizes = near.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("pages"))
    paged = near.join(F.broadcast(sizes), "pivot").withColumn("page", F.pmod(F.xxhash64("vec_id", F.lit("page")), F.col("pages")))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        v = matrix(table.column("v").combine_chunks())
        points = np.hstack([v.astype(float), np.sqrt(np.maximum(longest - (v * v).sum(axis=1), 0).astype(float))[:, None]])
        tree = Tree(points)
        place = np.empty(len(v), np.int64)
        place[tree.order] = np.arange(len(v))
        nodes = np.array(tree.nodes, dtype=float)
        nodes[:, 0] = place[nodes[:, 0].astype(np.int64)]
        ids = table.column("vec_id").to_numpy()[tree.order]
        arrays = [ids, v[tree.order].ravel(), nodes.ravel(), tree.point_parent]
        return pa.table({name: pa.array([a.tobytes()]) for name, a in zip(("ids", "vectors", "nodes", "parents"), arrays)})

    pages = stage(paged.groupBy("pivot", "page").applyInArrow(build, "ids binary, vectors binary, nodes binary, parents binary"))
    queries = rows.where(is_query)
    n_blocks = max(1, -(-queries.count() // QUERIES))
    packed = queries.groupBy(F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(n_blocks)).alias("block")).agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    meeting = pages.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    # the pages that meet a block are dealt to SPREAD tasks
    turns = F.explode(F.array(*[F.lit(turn) for turn in range(SPREAD)]))
    met = meeting.withColumn("turn", F.pmod(F.xxhash64("ids"), F.lit(SPREAD)).cast("int")).join(packed.withColumn("turn", turns), ["block", "turn"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[tuple, list] = {}  # the best scores that this task has met, by query row: k rows reach the last of them
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                v = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1).astype(float)
                points = np.hstack([v, np.sqrt(np.maximum(longest - (v * v).sum(axis=1), 0))[:, None]])
                nodes = np.frombuffer(row["nodes"]).reshape(-1, 6)
                tree = (*[nodes[:, i].astype(np.int64) if i in (0, 3, 4) else nodes[:, i] for i in range(6)], np.frombuffer(row["parents"]))
                found = []
                asked = sorted((q["vec_id"], q["v"]) for q in row["queries"])
                wanted = np.array([v for _, v in asked], dtype=float)
                at_pivots = wanted @ pivots.T.astype(float)
                for i, (own, v_own) in enumerate(asked):
                    query = (own, tuple(v_own))
                    if query not in reached:
                        others = at_pivots[i][pivot_ids != own] if len(pivot_ids) else np.zeros(0)
                        reached[query] = [[], np.sort(others)[-k] if len(others) >= k else None]
                    scores, start = reached[query]
                    floor = max(scores[-1], start) if len(scores) == k and start is not None else scores[-1] if len(scores) == k else start
                    more = search(wanted[i], own, ids, v, points, tree, k, floor)
                    if (own, v_own) != asked[i - 1] or not i:  # a repeated row meets the same page again
                        reached[query][0] = sorted([*scores, *[score for score, _ in more]], reverse=True)[:k]
                    found += [(own, vec, score) for score, vec in more]
                columns = np.array(found, dtype=np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(columns[:, i]) for i in range(3)], names=["query_id", "vec_id", "score"])

    found = met.select("ids", "vectors", "nodes", "parents", "queries").mapInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)
