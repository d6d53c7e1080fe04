"""Vectors as short codes: one codebook per part position, fitted by exact integer k-means.

Each component x becomes the integer floor(scale * x), and a vector is cut into equal consecutive
parts. A part position's codebook starts as that part of the vectors with the smallest ids. Each
round assigns every part to its nearest entry and replaces each entry by the componentwise floor of
its parts' mean; at the end parts are assigned once more.

Assignments are found by pivots (LAESA). Of the first codebook of each position ``PIVOTS`` entries
that lie far apart stay as pivots; the distance of every part to them is computed once and kept
beside the vector. In a round the distances of pivots to entries are known, and by the triangle
inequality |d(part, pivot) - d(pivot, entry)| is never more than d(part, entry). A part takes the
entries in the order of these bounds, evaluates them by exact integers, and stops where a bound
exceeds the best distance so far. Bounds are lowered by more than the rounding of their floats, and
equal distances go to the smaller index, so the result is that of evaluating every entry.

A round is one pass over the kept table: tasks add up their own sums, and as many sums as the
codebooks have components reach the driver.

Defined cases: rows whose vector is NULL or holds NULL or non-finite components take no part, nor
do rows of another dimension than most rows have (of equally frequent ones the smaller) or with a
scaled component of 2^24 or more, whose errors might not fit a long. NULL ids come last among the
first entries; rows that repeat count each; with fewer rows than entries a codebook is as long as
there are rows; a dimension that the parts do not divide is filled up with zeros; a column that
has one of the operator's own names is dropped; an empty table gives no rows.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyhouse.scratch import keep

PIVOTS = 4
MOST = 1 << 24
_FAR = np.iinfo(np.int64).max
_OWN = ["_x", "v", "to_pivots", "code", "error"]


@dataclass
class Codes:
    """``rows`` with ``code`` and ``error``, the final codebooks (part, entry, component), and how
    many distances to entries were evaluated in the rounds."""

    rows: DataFrame
    codebooks: np.ndarray
    evaluated: list[int] = field(default_factory=list)

    def digest(self) -> str:
        """SHA-256 of all components as decimal numbers with commas, by part, entry and place."""
        return sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def scaled(rows: DataFrame, scale: int) -> DataFrame:
    """``rows`` that take part, with ``v``, the integer components."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall("_x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < MOST))
    whole = F.transform("_x", lambda c: F.floor(c * scale).cast("int"))
    return rows.withColumn("_x", x).where(F.col("_x").isNotNull() & finite).select(
        *[c for c in rows.columns if c != "embedding"], whole.alias("v")
    )


def most_common_size(rows: DataFrame) -> int:
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return most["d"] if most else 0


def _parts(batch: pa.RecordBatch, n_parts: int) -> np.ndarray:
    """(row, part, place), filled up with zeros."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = flat.reshape(batch.num_rows, -1)
    return np.pad(rows, ((0, 0), (0, -rows.shape[1] % n_parts))).reshape(batch.num_rows, n_parts, -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors along the last axis."""
    return ((a - b) ** 2).sum(axis=-1)


def choose_pivots(codebooks: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Of each position the first entry, then always the one farthest from those chosen."""
    chosen = []
    for entries in codebooks:
        picked = [0]
        while len(picked) < min(n, len(entries)):
            gaps = _squared(entries[:, None], entries[picked][None]).min(axis=1)
            picked.append(int(gaps.argmax()))
        chosen.append(entries[picked])
    return np.array(chosen)


def _with_pivot_distances(pivots: np.ndarray):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _parts(batch, len(pivots))
            far = np.sqrt(_squared(parts[:, :, None], pivots[None])).astype("<f4")
            kept = pa.array([row.tobytes() for row in far], pa.binary())
            yield batch.append_column("to_pivots", kept)

    return of_batches


def nearest_entries(
    parts: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray, codebooks: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Entry and squared distance of every part, and how many distances were evaluated."""
    n, n_parts = parts.shape[:2]
    entry, squared = np.zeros((n, n_parts), np.int64), np.full((n, n_parts), _FAR)
    evaluated = 0
    for m, entries in enumerate(codebooks):
        known = np.sqrt(_squared(pivots[m][:, None], entries[None]))  # pivot, entry
        near = to_pivots[:, m, :, None].astype(float)
        bounds = (np.abs(near - known) - 1e-6 * (near + known)).max(axis=1) - 1e-6
        order = bounds.argsort(axis=1, kind="stable")
        bounds = np.take_along_axis(bounds, order, axis=1)
        open_rows = np.arange(n)
        best, own = squared[:, m], entry[:, m]
        for rank in range(len(entries)):
            open_rows = open_rows[bounds[open_rows, rank] <= np.sqrt(best[open_rows].astype(float))]
            if not len(open_rows):
                break
            tried = order[open_rows, rank]
            found = _squared(parts[open_rows, m], entries[tried])
            evaluated += len(open_rows)
            before = best[open_rows]
            better = (found < before) | ((found == before) & (tried < own[open_rows]))
            best[open_rows[better]] = found[better]
            own[open_rows[better]] = tried[better]
    return entry, squared, evaluated


def _assigned(batch: pa.RecordBatch, pivots: np.ndarray, codebooks: np.ndarray):
    parts = _parts(batch, len(codebooks))
    far = np.frombuffer(b"".join(batch.column("to_pivots").to_pylist()), "<f4")
    return parts, *nearest_entries(parts, far.reshape(len(parts), *pivots.shape[:2]), pivots, codebooks)


_SUMS = "part int, entry int, place int, total long, n long, evaluated long"


def _partial_sums(pivots: np.ndarray, codebooks: np.ndarray):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts, evaluated = np.zeros_like(codebooks), np.zeros(codebooks.shape[:2], np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, entry, _, tried = _assigned(batch, pivots, codebooks)
            evaluated += tried
            for m in range(len(codebooks)):
                np.add.at(totals[m], entry[:, m], parts[:, m])
                counts[m] += np.bincount(entry[:, m], minlength=counts.shape[1])
        part, at, place = np.indices(totals.shape).reshape(3, -1)
        shares = np.zeros(totals.size, np.int64)
        shares[0] = evaluated
        columns = part, at, place, totals.ravel(), np.repeat(counts.ravel(), totals.shape[2]), shares
        kinds = [pa.int32()] * 3 + [pa.int64()] * 3
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SUMS.split(", ")])

    return of_batches


def _updated(kept: DataFrame, pivots: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, int]:
    sums = kept.select("v", "to_pivots").mapInArrow(_partial_sums(pivots, codebooks), _SUMS)
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    sums = sums.groupBy("part", "entry", "place").agg(total, F.sum("n").alias("n"), F.sum("evaluated").alias("e"))
    new, evaluated = codebooks.copy(), 0
    for row in sums.toLocalIterator():
        evaluated += row["e"]
        if row["n"]:
            new[row["part"], row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return new, evaluated


def _coded(pivots: np.ndarray, codebooks: np.ndarray, kept: list[str]):
    digits = np.array([f"{i:02x}" for i in range(codebooks.shape[1])])

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, entry, squared, _ = _assigned(batch, pivots, codebooks)
            codes = pa.array(["".join(row) for row in digits[entry]], pa.string())
            columns = [*(batch.column(c) for c in kept), codes, pa.array(squared.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "code", "error"])

    return of_batches


def compress(
    rows: DataFrame, n_parts: int = 8, n_entries: int = 16, rounds: int = 6, scale: int = 4096
) -> Codes:
    """Codes of ``rows`` (``vec_id``, ``embedding`` and columns to keep): two hex digits a part."""
    if not 0 < n_entries <= 256:
        raise ValueError("a part's code has two hex digits, so 256 entries at most")
    others = [c for c in rows.columns if c not in ("embedding", *_OWN)]
    whole = keep(scaled(rows.select(*others, "embedding"), scale), "scaled")
    size = most_common_size(whole)
    whole = whole.where(F.size("v") == size)
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(n_entries).collect()
    schema = T.StructType(
        [*[rows.schema[c] for c in others], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    if not first or not size:
        return Codes(rows.sparkSession.createDataFrame([], schema), np.zeros((n_parts, 0, 0), np.int64))
    seeds = np.array([row["v"] for row in first], np.int64)
    seeds = np.pad(seeds, ((0, 0), (0, -size % n_parts))).reshape(len(first), n_parts, -1)
    codebooks = np.ascontiguousarray(seeds.transpose(1, 0, 2))  # part, entry, place
    pivots = choose_pivots(codebooks)
    with_pivots = T.StructType([*whole.schema.fields, T.StructField("to_pivots", T.BinaryType())])
    kept = keep(whole.mapInArrow(_with_pivot_distances(pivots), with_pivots), "parts")
    evaluated = []
    for _ in range(rounds):
        codebooks, tried = _updated(kept, pivots, codebooks)
        evaluated.append(tried)
    return Codes(kept.mapInArrow(_coded(pivots, codebooks, others), schema), codebooks, evaluated)
