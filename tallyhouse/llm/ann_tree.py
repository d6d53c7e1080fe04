"""Approximate nearest neighbours by a hierarchical k-means tree and best-bin-first search.

The tree is fitted on at most ``SAMPLE`` different vectors, the smallest by hash; every vector
is then indexed, in the leaf it reaches by going to the nearest centre at each level. A query
walks the tree with a priority queue: the open node with the nearest centre is expanded next,
and leaves are visited in the order they come up. How many leaves a query visits is calibrated:
for ``CALIBRATION`` vectors the true neighbours are found by comparing them with all rows, and
leaves are added until the share of true neighbours found, less two standard errors, reaches
``recall``. Visits go on in any case until enough candidates have been met.

Equal vectors are one entry, with their k + 1 smallest ids: no more of them can be among the k
nearest of anything. A leaf is read in blocks of about ``BLOCK`` vectors and its queries in
blocks of about ``QUERY_BLOCK``, so neither a crowded leaf nor a popular one meets in one task.
Distances are double precision on the original vectors.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components take no part,
nor do rows with a NULL id or with another dimension than most rows have (of equally frequent
ones the smaller); repeated rows count once; with fewer candidates than k all are returned.
"""

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.scratch import keep

SAMPLE = 20_000
CALIBRATION = 200
BRANCHES = 16
LEAF_SAMPLE = 128
BLOCK = 2048
QUERY_BLOCK = 512
_AT_ONCE = 1 << 22  # components compared at a time


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the vectors that take part, each pair once."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    some = F.exists("v", lambda x: x != 0)
    rows = rows.select("vec_id", v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = keep(rows.where(finite & some).distinct(), "usable")
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (most["d"] if most else 0))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all of ``b``, from their differences."""
    out = np.empty((len(a), len(b)))
    step = max(1, _AT_ONCE // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = ((a[i : i + step, None, :] - b[None]) ** 2).sum(axis=2)
    return out


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        own = _nearest_centre(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        count = np.bincount(own, minlength=k)[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres, _nearest_centre(points, centres)


def _nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


class Tree:
    """``children[n]`` are the nodes below node n; a node without any is a leaf."""

    def __init__(self, sample: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.centres, self.children = [sample.mean(axis=0)], [[]]
        todo = [(0, sample)]
        while todo:
            node, points = todo.pop()
            if len(points) <= LEAF_SAMPLE:
                continue
            centres, own = _k_means(points, min(BRANCHES, len(points)), rng)
            held = [c for c in range(len(centres)) if (own == c).any()]
            if len(held) < 2:
                continue
            for c in held:
                self.children[node].append(len(self.children))
                todo.append((len(self.children), points[own == c]))
                self.centres.append(centres[c])
                self.children.append([])
        self.centres = np.array(self.centres)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        leaves = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                leaves[rows] = node
                continue
            own = _nearest_centre(points[rows], self.centres[below])
            todo += [(below[c], rows[own == c]) for c in np.unique(own)]
        return leaves

    def best_bins(self, point: np.ndarray) -> Iterator[int]:
        """All leaves, the most promising first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield node
                continue
            far = ((self.centres[below] - point) ** 2).sum(axis=1)
            for distance, child in zip(far.tolist(), below, strict=True):
                heapq.heappush(queue, (distance, child))


def _stacked(column) -> np.ndarray:
    if not len(column):
        return np.empty((0, 0))
    return np.stack(column if isinstance(column, list) else list(column))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 0))


def _with_leaf(tree: Tree):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = pa.array(tree.leaf_of(_matrix(batch, "v")))
                yield pa.RecordBatch.from_arrays([*batch.columns, leaves], [*batch.schema.names, "leaf"])

    return of_batches


def _nearest_of_all(queries: np.ndarray, k: int):
    """The k nearest rows of each query, of those a task reads; ties to the smaller id."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.empty((0, 4))
        for batch in batches:
            if not batch.num_rows:
                continue
            squared = _squared(queries, _matrix(batch, "v"))
            ids, leaves = (batch.column(c).to_numpy() for c in ("vec_id", "leaf"))
            for q in range(len(queries)):
                near = np.argsort(squared[q], kind="stable")[:k]
                rows = np.stack([np.full(len(near), q), squared[q][near], ids[near], leaves[near]], axis=1)
                best = np.concatenate([best, rows])
            order = np.lexsort((best[:, 2], best[:, 1], best[:, 0]))
            best = best[order]
            rank = np.arange(len(best)) - np.searchsorted(best[:, 0], best[:, 0])
            best = best[rank < k]
        columns = [pa.array(best[:, i].astype(t)) for i, t in enumerate(("i8", "f8", "i8", "i8"))]
        yield pa.RecordBatch.from_arrays(columns, ["q", "squared", "vec_id", "leaf"])

    return of_batches


def _calibrated_visits(indexed: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """Leaves to visit, from true neighbours of a bounded set of vectors among all rows."""
    picked = indexed.orderBy(F.xxhash64(F.lit("calibration"), "v"), "vec_id").limit(CALIBRATION).collect()
    queries = np.array([row["v"] for row in picked])
    found = indexed.select("vec_id", "v", "leaf").mapInArrow(
        _nearest_of_all(queries, k + 1), "q long, squared double, vec_id long, leaf long"
    )
    nearest = Window.partitionBy("q").orderBy("squared", "vec_id")
    found = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k + 1)
    truth = found.toPandas()  # CALIBRATION * (k + 1) rows at most
    needed = []
    for q, rows in truth.groupby("q"):
        order = {leaf: i for i, leaf in enumerate(tree.best_bins(queries[q]))}
        others = rows[rows["vec_id"] != picked[q]["vec_id"]].nsmallest(k, ["squared", "vec_id"])
        if len(others):
            needed.append(sorted(order[leaf] for leaf in others["leaf"]))
    n_leaves = sum(not c for c in tree.children)
    for visits in range(1, n_leaves + 1):
        share = np.array([np.mean(np.array(x) < visits) for x in needed])
        if not len(share) or share.mean() - 2 * share.std() / np.sqrt(len(share)) >= recall:
            return visits
    return n_leaves


def _visits(tree: Tree, visits: int, least: int, held: dict[int, int]):
    """``held``: how many ids each leaf has."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, leaves = [], []
            for i, point in enumerate(_matrix(batch, "v")):
                met = 0
                for n, leaf in enumerate(tree.best_bins(point)):
                    if n >= visits and met >= least:
                        break
                    if leaf in held:
                        met += held[leaf]
                        rows.append(i)
                        leaves.append(leaf)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(leaves, pa.int64())], [*batch.schema.names, "leaf"]
            )

    return of_batches


def _compared(k: int):
    """Of one block of a leaf the k nearest vectors of each query of one block."""

    def block(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q": [], "squared": [], "ids": []})
        if not len(queries) or not len(rows):
            return empty
        rows = rows.sort_values("vec_id", kind="stable")
        squared = _squared(_stacked(queries["v"]), _stacked(rows["v"]))
        near = np.argsort(squared, axis=1, kind="stable")[:, :k]
        return pd.DataFrame(
            {
                "q": np.repeat(queries["q"].to_numpy(), near.shape[1]),
                "squared": np.take_along_axis(squared, near, axis=1).ravel(),
                "ids": rows["ids"].to_numpy()[near.ravel()],
            }
        )

    return block


def _per_leaf(counts: dict[int, int], size: int):
    """The number of blocks of the row's leaf; only crowded leaves are spelled out."""
    pairs = [F.lit(x) for leaf, n in counts.items() if n > size for x in (leaf, -(-n // size))]
    if not pairs:
        return F.lit(1)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("leaf")), F.lit(1))


def search(rows: DataFrame, is_query, k: int = 10, recall: float = 0.95) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of each row that fits ``is_query``.

    ``rows``: ``vec_id, embedding``.
    """
    spark = rows.sparkSession
    each = keep(usable(rows), "vectors")
    smallest = Window.partitionBy("v").orderBy("vec_id")
    few = each.withColumn("_nth", F.row_number().over(smallest)).where(F.col("_nth") <= k + 1)
    entries = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = keep(entries.withColumn("vec_id", F.get("ids", F.lit(0))), "entries")
    sample = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree(np.array([row["v"] for row in sample]))
    indexed = keep(
        entries.mapInArrow(_with_leaf(tree), "v array<double>, ids array<long>, vec_id long, leaf long"),
        "indexed",
    )
    per_leaf = indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("held"))
    per_leaf = per_leaf.collect()  # a row per leaf
    visits = _calibrated_visits(indexed, tree, k, recall)
    queries = each.where(is_query).join(entries.select("v", F.col("vec_id").alias("q")), "v")
    queries = keep(queries.select(F.col("vec_id").alias("query_id"), "q"), "queries")
    points = indexed.join(queries.select("q").distinct(), F.col("vec_id") == F.col("q")).select("q", "v")
    held = {row["leaf"]: row["held"] for row in per_leaf}
    walked = points.mapInArrow(_visits(tree, visits, k + 1, held), "q long, v array<double>, leaf long")
    walked = keep(walked, "visits")
    visitors = {row["leaf"]: row["count"] for row in walked.groupBy("leaf").count().collect()}
    if not visitors:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = _per_leaf({row["leaf"]: row["n"] for row in per_leaf}, BLOCK)
    query_blocks = _per_leaf(visitors, QUERY_BLOCK)
    left = walked.select(
        "leaf",
        F.pmod(F.xxhash64("q"), query_blocks).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("b"),
        "q",
        "v",
    )
    visited = indexed.join(walked.select("leaf").distinct(), "leaf", "left_semi")
    right = visited.select(
        "leaf",
        F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("qb"),
        F.pmod(F.xxhash64("vec_id"), blocks).cast("int").alias("b"),
        "vec_id",
        "v",
        "ids",
    )
    keys = ["leaf", "qb", "b"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _compared(k + 1), "q long, squared double, ids array<long>"
    )
    by_distance = Window.partitionBy("q").orderBy("squared", F.get("ids", F.lit(0)))
    nearest = found.withColumn("_nth", F.row_number().over(by_distance)).where(F.col("_nth") <= k + 1)
    pairs = nearest.select("q", "squared", F.explode("ids").alias("vec_id"))
    lists = pairs.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("squared", "vec_id"))).alias("near"))
    mine = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    answered = queries.join(lists, "q").select("query_id", F.posexplode(mine).alias("at", "hit"))
    return answered.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        F.sqrt("hit.squared").alias("score"),
    )
