"""Hard negatives by inner product, from lists that a cluster of anchors shares (MAXIMUS).

Anchors are clustered by direction. For a cluster with centre c and widest angle w between c and
its members, no member u scores a row i higher than |u| |i| cos(max(0, angle(i, c) - w)). So every
cluster's list holds the rows by |i| cos(max(0, angle(i, c) - w)), highest first, sorted once, and
all members walk it together: first for their positives, the best rows of the same label, then for
the negatives of each positive, the best rows of another label whose score lies within a share of
the positive's score. A member stops as soon as it is certain that the rest of the list cannot
change its answer: what it holds is full and better than the bound of all that follows, or that
bound lies below the least score it may take. Scores are exact integers, so the answer is that of
comparing every anchor with every row.

A list is cut at quantiles of its bounds into segments of 1/64, 3/64, 3/16 and 3/4 of the rows, and
a round walks one segment. Within it the members that are not done meet the rows in blocks of about
``QUERY_BLOCK`` and ``BLOCK``, whatever the size of the cluster or the label; small clusters are packed
together, so that a row is sent once for all of them. Bounds are raised by more than the rounding of
their floats. The centres are fitted on at most ``SAMPLE`` anchors, the
smallest by hash of their id; they decide how early walks end, never their outcome.

Defined cases: rows with a NULL id, a NULL label or a NULL vector, or with a NULL, non-finite or
scaled component of 2^24 or more take no part, nor do rows of another dimension than most have (of
equally frequent ones the smaller). An id that repeats counts once, with its smallest label and
vector. A zero vector scores 0 with every row and takes part. An anchor without another row of its
label, or a positive with a score below 0, has no negatives; other columns are ignored; an empty table
gives no rows.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.vector_codes import most_common_size, scaled
from tallyhouse.scratch import keep

SAMPLE = 20_000
CLUSTERS = 16
ANCHORS_PER_CLUSTER = 64
QUERY_BLOCK = 2048
BLOCK = 2048
SHARES = [1 / 64, 1 / 16, 1 / 4]  # of the rows, up to the end of a segment; the last has the rest
_SLACK = 1e-6
_ANSWER = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part, each id once."""
    whole = scaled(rows.select("vec_id", "label", "embedding"), scale)
    whole = whole.where("vec_id IS NOT NULL AND label IS NOT NULL")
    once = whole.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return once.select("vec_id", F.col("r.label").cast("long").alias("label"), "r.v")


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((vectors**2).sum(axis=1))
    return vectors / np.where(norms > 0, norms, 1)[:, None], norms


def fit_centres(vectors: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centres of directions."""
    units = _units(vectors)[0]
    rng = np.random.default_rng(seed)
    centres = units[rng.choice(len(units), min(k, len(units)), replace=False)]
    for _ in range(rounds):
        own = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        length = np.sqrt((sums**2).sum(axis=1))[:, None]
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def _angles(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    units, norms = _units(vectors)
    return np.arccos(np.clip(units @ centres.T, -1, 1)), norms


def _in_clusters(centres: np.ndarray):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            angles, norms = _angles(_matrix(batch.column("v"), batch.num_rows), centres)
            own = np.where(norms > 0, angles.argmin(axis=1), 0)
            angle = np.where(norms > 0, angles[np.arange(len(own)), own], 0.0)
            added = pa.array(own, pa.int32()), pa.array(angle), pa.array(norms)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], [*batch.schema.names, "cluster", "angle", "norm"]
            )

    return of_batches


def bounds(vectors: np.ndarray, centres: np.ndarray, widest: np.ndarray) -> np.ndarray:
    """What a row scores at most with a member of length 1, per cluster."""
    angles, norms = _angles(vectors, centres)
    nearest = np.clip(angles - widest - _SLACK, 0, np.pi)
    return norms[:, None] * (np.cos(nearest) + _SLACK)


def _with_bounds(centres: np.ndarray, widest: np.ndarray):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = bounds(_matrix(batch.column("v"), batch.num_rows), centres, widest)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32()), pa.array(found.ravel())
            )
            yield batch.append_column("bounds", lists)

    return of_batches


class Lists:
    """The rows with their bounds, and where the list of each cluster is cut."""

    def __init__(self, rows: DataFrame, n_clusters: int):
        self.rows, self.n_clusters = rows, n_clusters
        shares = [1 - s for s in SHARES]
        cuts = [F.percentile_approx(F.get("bounds", F.lit(k)), shares, 10_000).alias(f"c{k}") for k in range(n_clusters)]
        row = rows.agg(*cuts).first()
        self.cuts = [[np.inf, *sorted(row[f"c{k}"], reverse=True), -np.inf] for k in range(n_clusters)]
        held = [
            F.count_if(self.within(k, r)).alias(f"n{k}_{r}") for k in range(n_clusters) for r in range(self.n_segments)
        ]
        row = rows.agg(*held).first()
        self.held = [[row[f"n{k}_{r}"] for r in range(self.n_segments)] for k in range(n_clusters)]
        self.n_rows = sum(self.held[0])

    n_segments = len(SHARES) + 1

    def within(self, cluster: int, segment: int) -> Column:
        bound, cuts = F.get("bounds", F.lit(cluster)), self.cuts[cluster]
        return (bound >= cuts[segment + 1]) & (bound < cuts[segment])

    def segment(self, packs: list[list[int]], segment: int) -> DataFrame:
        """``pack, clusters, vec_id, label, v``: a row for each pack that has clusters whose list has it there."""
        held = []
        for pack, clusters in enumerate(packs):
            found = F.array_compact(F.array(*[F.when(self.within(k, segment), F.lit(k)) for k in clusters]))
            held.append(F.struct(F.lit(pack).alias("pack"), found.alias("clusters")))
        met = F.filter(F.array(*held), lambda h: F.size(h["clusters"]) > 0)
        return self.rows.select(F.explode(met).alias("met"), "vec_id", "label", "v").select(
            "met.*", "vec_id", "label", "v"
        )


def packed(members: dict[int, int]) -> list[list[int]]:
    """Clusters in packs of ``QUERY_BLOCK`` members at most; a larger cluster is a pack of its own."""
    packs: list[list[int]] = []
    room = 0
    for cluster in sorted(members, key=lambda k: (-members[k], k)):
        if members[cluster] > room:
            packs.append([])
            room = max(QUERY_BLOCK, members[cluster])
        packs[-1].append(cluster)
        room -= members[cluster]
    return packs


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    largest = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 1 << 53:  # every sum is a whole number that a double holds
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _block(same_label: bool, most: int):
    """Of one block of rows the ``most`` best for every want of one block of members."""

    def best(members: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if members.num_rows and rows.num_rows:
            rows = rows.sort_by("vec_id")
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            listed = rows["clusters"].combine_chunks()
            holds = np.zeros((rows.num_rows, CLUSTERS), bool)
            holds[listed.value_parent_indices().to_numpy(), listed.flatten().to_numpy()] = True
            scores = _scores(_matrix(members["v"], members.num_rows), _matrix(rows["v"], rows.num_rows))
            who = zip(*(members[c].to_pylist() for c in ("cluster", "vec_id", "label", "wants")), strict=True)
            for (cluster, anchor, label, wants), row in zip(who, scores, strict=True):
                fits = np.flatnonzero(holds[:, cluster] & ((labels == label) == same_label) & (ids != anchor))
                fits = fits[np.argsort(-row[fits], kind="stable")]  # ties by smaller id
                falling = -row[fits]
                for want in wants:
                    start = np.searchsorted(falling, -want["high"])
                    end = np.searchsorted(falling, -want["low"], side="right")
                    for i in fits[start : min(end, start + most)]:
                        found.append((anchor, want["slot"], int(row[i]), int(ids[i])))
        names = ["anchor_id", "slot", "score", "vec_id"]
        columns = zip(*found, strict=True) if found else [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return best


def _mapped(values: list[int], key: str) -> Column:
    return F.create_map(*[F.lit(x) for pair in enumerate(values) for x in pair])[F.col(key)]


def walk(members: DataFrame, lists: Lists, same_label: bool, most: int) -> DataFrame:
    """``anchor_id, slot, rank, score, vec_id``: the best ``most`` rows for every want of a member.

    ``members``: ``cluster, vec_id, label, v, norm`` and ``wants``, an array of (slot, low, high);
    a want takes scores from ``low`` to ``high``.
    """
    found: DataFrame | None = None
    for segment in range(lists.n_segments):
        waiting = {r["cluster"]: r["count"] for r in members.groupBy("cluster").count().collect()}
        if not waiting:
            break
        packs = packed(waiting)
        pack_of = F.create_map(*[F.lit(x) for p, clusters in enumerate(packs) for k in clusters for x in (k, p)])
        here = [min(lists.n_rows, sum(lists.held[k][segment] for k in clusters)) for clusters in packs]
        row_blocks = _mapped([max(1, -(-n // BLOCK)) for n in here], "pack")
        member_blocks = _mapped([-(-sum(waiting[k] for k in c) // QUERY_BLOCK) for c in packs], "pack")
        left = members.withColumn("pack", pack_of[F.col("cluster")]).select(
            "pack",
            F.pmod(F.xxhash64("vec_id"), member_blocks).cast("int").alias("mb"),
            F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("rb"),
            "cluster",
            "vec_id",
            "label",
            "v",
            "wants",
        )
        right = lists.segment(packs, segment).select(
            "pack",
            F.explode(F.sequence(F.lit(0), member_blocks - 1)).alias("mb"),
            F.pmod(F.xxhash64("vec_id"), row_blocks).cast("int").alias("rb"),
            "clusters",
            "vec_id",
            "label",
            "v",
        )
        keys = ["pack", "mb", "rb"]
        met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            _block(same_label, most), "anchor_id long, slot long, score long, vec_id long"
        )
        met = met if found is None else met.unionByName(found.drop("rank"))
        order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
        ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
        found = keep(ranked, "found")
        if segment + 1 < lists.n_segments:
            members = keep(_not_certain(members, found, lists, segment, most), "members")
    if found is None:
        raise ValueError("a walk needs members")
    return found


def _not_certain(members: DataFrame, found: DataFrame, lists: Lists, segment: int, most: int) -> DataFrame:
    """The members, and of their wants those that the rest of the list may still change.

    A want that is full takes nothing below the worst it holds any more.
    """
    follows = F.create_map(*[F.lit(x) for k in range(lists.n_clusters) for x in (k, lists.cuts[k][segment + 1])])
    at_most = F.col("norm") * follows[F.col("cluster")]
    at_most = at_most + F.abs(at_most) * _SLACK + _SLACK
    full = found.groupBy("anchor_id", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    full = full.where(F.col("n") == most).groupBy("anchor_id")  # as many as a member has wants
    full = full.agg(F.map_from_entries(F.collect_list(F.struct("slot", "worst"))).alias("full"))
    joined = members.join(full.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left")

    def raised(want: Column) -> Column:
        worst = F.try_element_at(F.col("full"), want["slot"])
        return _want(want["slot"], F.greatest(want["low"], worst), want["high"])

    raised_wants = F.filter(F.transform("wants", raised), lambda want: at_most >= want["low"])
    return joined.withColumn("wants", raised_wants).where(F.size("wants") > 0).select(*members.columns)


def _want(slot: Column, low: Column, high: Column) -> Column:
    return F.struct(slot.alias("slot"), low.alias("low"), high.alias("high"))


def mine(
    rows: DataFrame,
    is_anchor: Column | str,
    n_positives: int = 5,
    n_negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows``: ``vec_id, label, embedding``. A negative's score lies between ``least`` and ``most``
    hundredths of the positive's.
    """
    spark = rows.sparkSession
    each = keep(usable(rows, scale), "vectors")
    each = each.where(F.size("v") == most_common_size(each))
    chosen = keep(each.where(is_anchor), "anchors")
    sample = chosen.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], _ANSWER)
    n_clusters = min(CLUSTERS, -(-sample.num_rows // ANCHORS_PER_CLUSTER))
    centres = fit_centres(_matrix(sample["v"], sample.num_rows), n_clusters)
    schema = "vec_id long, label long, v array<int>"
    anchors = chosen.select("vec_id", "label", "v").mapInArrow(
        _in_clusters(centres), f"{schema}, cluster int, angle double, norm double"
    )
    anchors = keep(anchors, "anchors")
    widest = np.zeros(len(centres))
    for row in anchors.groupBy("cluster").agg(F.max("angle").alias("w")).collect():
        widest[row["cluster"]] = row["w"]
    bounded = each.select("vec_id", "label", "v").mapInArrow(
        _with_bounds(centres, widest), f"{schema}, bounds array<double>"
    )
    lists = Lists(keep(bounded, "lists"), len(centres))

    members = anchors.select("cluster", "vec_id", "label", "v", "norm")
    far = F.lit(1 << 62)
    any_score = F.array(_want(F.lit(0).cast("long"), -far, far)).alias("wants")
    positives = walk(members.select("*", any_score), lists, True, n_positives)
    positives = positives.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    low = F.expr(f"({least} * positive_score + 99) div 100")
    high = F.expr(f"{most} * positive_score div 100")
    wanted = positives.where(F.col("positive_score") >= 0).groupBy(F.col("anchor_id").alias("vec_id"))
    wanted = wanted.agg(F.collect_list(_want(F.col("positive_id"), low, high)).alias("wants"))
    members = keep(members.join(wanted, "vec_id").select(*members.columns, "wants"), "members")
    if members.isEmpty():
        return spark.createDataFrame([], _ANSWER)
    negatives = walk(members, lists, False, n_negatives).select(
        "anchor_id",
        F.col("slot").alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    answer = negatives.join(positives, ["anchor_id", "positive_id"])
    return answer.select(*[c.split()[0] for c in _ANSWER.split(", ")])
