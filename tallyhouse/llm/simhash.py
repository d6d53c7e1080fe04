"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two that differ in at most ``max_bits`` = 4 bits
differ in at most four bytes, so they share at least ``MIN_SHARED`` = 4: that is the count a
pair must reach. Posting lists of single positional bytes would be met by every 256th pair;
here a list stands for a set of ``WIDTH`` = 3 positions and their bytes. The sets are Turan's
system: positions fall into three rings, and a set is taken if it lies in one ring, or has two
positions in a ring and one in the next. Any four positions contain such a set, so no pair that
shares four bytes misses all lists. In a list the shared positional bytes of each pair are
tallied, pairs below the count dropped, and the rest verified by their differing bits.

Equal fingerprints are one entry of the index. A task reads lists one after another and returns
links that join what is linked (a spanning forest of the list), not all pairs. A list longer
than ``LONGEST_LIST`` is dealt into blocks, and each pair of blocks is a list of its own, so no
list meets in one task and no pair is lost. Components come from ``components``.

Defined cases: NULL and empty texts have fingerprint zero and are linked with one another;
rows with a NULL id take part, get a component, and never name one unless all of it is NULL;
repeated rows are returned as often as they come.
"""

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from tallyhouse.llm.components import components
from tallyhouse.scratch import keep

N_BYTES = 8
MIN_SHARED = 4
WIDTH = 3
LONGEST_LIST = 2048
SHINGLE = 4
SEED = 42
_HASHES_AT_ONCE = 1 << 16


def _fingerprint(text: str | None) -> int:
    """As a signed 64-bit number."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    width = min(SHINGLE, len(found))
    stops = (ends[width - 1 :] - 1).tolist()
    starts = [0, *ends[: len(found) - width].tolist()]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        some = zip(starts[at : at + _HASHES_AT_ONCE], stops[at : at + _HASHES_AT_ONCE], strict=True)
        hashed = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in some], ">u8")
        bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(starts))
    return int(packed.view(">i8")[0])


def _with_fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = pa.array([_fingerprint(t.as_py()) for t in batch.column(0)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], values], [*batch.schema.names[1:], "_fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``_fp``, the fingerprint as a signed long, of each row."""
    return docs.select("text", "doc_id").mapInArrow(_with_fingerprints, "doc_id long, _fp long")


def covering_sets() -> list[tuple[int, ...]]:
    """The position sets of the index: any ``MIN_SHARED`` positions contain one of them."""
    ring = [position % 3 for position in range(N_BYTES)]

    def taken(chosen: tuple[int, ...]) -> bool:
        count = [sum(ring[p] == r for p in chosen) for r in range(3)]
        return any(count[r] == 3 or (count[r] == 2 and count[(r + 1) % 3] == 1) for r in range(3))

    return [chosen for chosen in combinations(range(N_BYTES), WIDTH) if taken(chosen)]


def _postings(distinct: DataFrame) -> DataFrame:
    def key(number: int, positions: tuple[int, ...]) -> Column:
        value = F.lit(number).cast("long")
        for p in positions:
            byte = F.shiftrightunsigned("_fp", 8 * p).bitwiseAND(255)
            value = F.shiftleft(value, 8).bitwiseOR(byte)
        return value

    keys = [key(number, positions) for number, positions in enumerate(covering_sets())]
    return distinct.select("_fp", F.explode(F.array(*keys)).alias("_list"))


def _in_blocks(postings: DataFrame) -> DataFrame:
    """Lists of two and more, long ones as one list for each pair of their blocks."""
    lengths = postings.groupBy("_list").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    half = LONGEST_LIST // 2
    blocks = F.when(F.col("_n") > LONGEST_LIST, F.ceil(F.col("_n") / half)).otherwise(F.lit(1))
    rows = postings.join(lengths, "_list").withColumn("_blocks", blocks.cast("int"))
    own = F.pmod(F.xxhash64("_fp"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    rows = rows.withColumn("_own", own).withColumn("_other", other)
    return rows.select(
        "_list",
        F.least("_own", "_other").alias("_a"),
        F.greatest("_own", "_other").alias("_b"),
        "_fp",
    )


def _near(one: np.uint64, others: np.ndarray, max_bits: int) -> np.ndarray:
    differing = others ^ one
    shared = (differing.view(np.uint8).reshape(-1, N_BYTES) == 0).sum(axis=1)
    met = shared >= MIN_SHARED
    met[met] = np.bitwise_count(differing[met]) <= max_bits
    return met


def _forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join whatever is linked within one list, each found from a visited member."""
    if len(members) == 2:
        differing = int(members[0] ^ members[1])
        shared = differing.to_bytes(N_BYTES, "little").count(0)
        near = shared >= MIN_SHARED and differing.bit_count() <= max_bits
        return [(int(members[0]), int(members[1]))] if near else []
    links, rest = [], members
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        root = int(reached[0])
        while reached and len(rest):
            near = _near(reached.pop(), rest, max_bits)
            found, rest = rest[near], rest[~near]
            links += [(root, int(f)) for f in found]
            reached += list(found)
    return links


def _links_of_lists(max_bits: int):
    def of_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lists come one after another; the last of a batch may go on in the next."""
        open_keys, open_fps = np.empty((0, 3), np.int64), np.empty(0, np.int64)
        for batch in _with_end(batches):
            if batch is not None:
                columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
                open_keys = np.concatenate([open_keys, np.stack(columns[:3], axis=1)])
                open_fps = np.concatenate([open_fps, columns[3]])
            if not len(open_fps):
                continue
            changes = np.flatnonzero((open_keys[1:] != open_keys[:-1]).any(axis=1)) + 1
            bounds = [0, *changes.tolist()] + ([len(open_fps)] if batch is None else [])
            links = []
            for start, stop in zip(bounds, bounds[1:], strict=False):
                if stop - start > 1:
                    links += _forest(open_fps[start:stop].view(np.uint64), max_bits)
            open_keys, open_fps = open_keys[bounds[-1] :], open_fps[bounds[-1] :]
            if links:
                ends = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])

    return of_lists


def _with_end(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints that join all that are near each other."""
    if not 0 <= max_bits <= N_BYTES - MIN_SHARED:
        raise ValueError(f"the index finds pairs of at most {N_BYTES - MIN_SHARED} differing bits")
    lists = _in_blocks(_postings(distinct))
    grouped = lists.repartition("_list", "_a", "_b").sortWithinPartitions("_list", "_a", "_b")
    grouped = grouped.select("_list", F.col("_a").cast("long"), F.col("_b").cast("long"), "_fp")
    return grouped.mapInArrow(_links_of_lists(max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, max_bits: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id`` of each row of ``docs``."""
    rows = keep(fingerprints(docs), "fingerprints")
    first = keep(rows.groupBy("_fp").agg(F.min("doc_id").alias("_first")), "distinct")
    roots = components(links(first.select("_fp"), max_bits))
    rooted = first.join(roots, first["_fp"] == roots["node"], "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_root")
    )
    least = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = rooted.select("_fp", "_root").join(least, "_root").select("_fp", "component_id")
    digits = F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint")
    return rows.join(named, "_fp").select("doc_id", digits, "component_id")


def keep_one(docs: DataFrame, max_bits: int = 4) -> DataFrame:
    """Of each component the row with its smallest id; of several rows of that id one.

    Rows without an id stay; so do all columns of ``docs``.
    """
    found = near_duplicates(docs, max_bits).where(F.col("doc_id") == F.col("component_id"))
    chosen = found.select("doc_id").distinct().hint("merge")  # as many as there are components
    named = docs.where(F.col("doc_id").isNotNull()).join(chosen, "doc_id", "left_semi")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id"))
    one_each = named.withColumn("_nth", nth).where(F.col("_nth") == 1).select(*docs.columns)
    return one_each.unionByName(docs.where(F.col("doc_id").isNull()))
