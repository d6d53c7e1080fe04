"""Mixing sources to target weights by the cube method.

A source of weight w should contribute a share of ``share`` times all words, by weight, but at
most ``most`` times its own words; what exceeds that goes to the others by weight. The ratio of
target to size is how often each of its documents is wanted: the whole part is taken for sure,
and the fraction is an inclusion probability, which balanced sampling turns into yes or no.

Flight phase: three undecided documents at a time have a direction in which their probabilities
can move while neither the expected words nor the expected number of documents change: the null
space of these two constraints. They are moved until one of them is decided, one way or the
other at random so that each keeps its probability on average. Groups are blocks of a source,
dealt by a hash, for which equal rows are numbered first; the ``LANDING`` documents that a block leaves
are dealt into fewer blocks, until one block per source is left. Landing phase: the last documents of a
source are decided together. Of all chances of their joint outcomes that give each document its
probability, a linear program finds those that miss the words, and next to them the number of
documents, least on average. Every level is a kept table.

All chance comes from hashes of the block and of the documents' ids and texts, so reruns agree.

Defined cases: NULL texts have no words; a NULL source is a source, the last in order; sources
without words get target 0; rows with equal ids are separate rows; NULL ids are ordinary.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm import repeats
from tallyhouse.llm.words import n_words
from tallyhouse.scratch import keep

WEIGHTS = (3.0, 1.0, 2.0)
BLOCK = 1000
LANDING = 12  # documents; the landing looks at all their 2^12 joint outcomes
DOCUMENT = 0.05  # what a document too many or too few counts, in mean sizes
MOST_STEPS = 2000
_NEAR = 1e-9
_UNITS = "_row long, source string, _order long, _nth long, _size long, _p double"


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``; sources take ``weights`` in turn.

    With caps a target is min(cap, weight * level). In the order of cap / weight the capped
    sources come first, so sums over those before decide where the level lies. The two
    windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    capped = sizes.withColumn("_weight", weight).withColumn("_cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0.0)
    rest = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), zero)
    left = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), zero)
    levels = capped.withColumn("_level", rest / left)
    free = F.col("_cap") > F.col("_weight") * F.col("_level")
    level = F.min_by("_level", F.when(free, F.col("_cap") / F.col("_weight"))).over(whole)
    at_level = F.col("_weight") * F.coalesce(level, F.lit(float("inf")))
    target = F.least(F.col("_cap").cast("double"), at_level)
    return levels.withColumn("target", target).select("source", "source_size", "target")


def _direction(a: int, b: int, c: int) -> tuple[int, int, int]:
    """Leaves both the sum and the sum weighted by a, b, c as it is."""
    return (b - c, c - a, a - b) if (a != b or b != c) else (1, -1, 0)


def _moved(p: list[float], u: tuple[int, ...], chance: float) -> list[float]:
    up = min(((1 - x) if d > 0 else x) / abs(d) for x, d in zip(p, u, strict=True) if d)
    down = min((x if d > 0 else (1 - x)) / abs(d) for x, d in zip(p, u, strict=True) if d)
    step = up if chance * (up + down) < down else -down
    return [x + step * d for x, d in zip(p, u, strict=True)]


def _flight(
    sizes: list[int], p: list[float], chance: Callable[[], float], among: list[int] | None = None
) -> list[int]:
    """Moves ``p`` in place; returns the one or two of ``among`` (all) that stay undecided."""
    open_ones: list[int] = []
    for i in range(len(p)) if among is None else among:
        if not 0 < p[i] < 1:
            continue
        open_ones.append(i)
        same_pair = len(open_ones) == 2 and sizes[open_ones[0]] == sizes[open_ones[1]]
        if len(open_ones) == 3 or same_pair:
            u = (1, -1) if same_pair else _direction(*(sizes[j] for j in open_ones))
            moved = _moved([p[j] for j in open_ones], u, chance())
            for j, x in zip(open_ones, moved, strict=True):
                p[j] = 0.0 if x < _NEAR else 1.0 if x > 1 - _NEAR else x
            open_ones = [j for j in open_ones if 0 < p[j] < 1]
    return open_ones


def _least_on_average(outcomes: np.ndarray, miss: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of outcomes and their chances: margins are ``p`` and the average of ``miss`` is least.

    Simplex steps from the chances of "all documents with p above a uniform number".
    """
    k = len(p)
    rows = np.vstack([outcomes.T.astype(float), np.ones(len(outcomes))])
    order = np.argsort(-p, kind="stable")
    basis = np.concatenate([[0], np.cumsum(1 << order)])
    for step in range(MOST_STEPS):
        held = rows[:, basis]
        gain = miss - np.linalg.solve(held.T, miss[basis]) @ rows
        better = np.flatnonzero(gain < -_NEAR * (1 + miss.max()))
        if not len(better):
            break
        # The largest gain first; later the first of all, which cannot go round in circles.
        enter = better[gain[better].argmin()] if step < MOST_STEPS // 4 else better[0]
        chances, moved = np.linalg.solve(held, np.append(p, 1.0)), np.linalg.solve(held, rows[:, enter])
        shrinking = np.flatnonzero(moved > _NEAR)
        ratio = np.maximum(chances[shrinking], 0.0) / moved[shrinking]
        least = shrinking[ratio <= ratio.min() + 1e-12]
        basis[least[basis[least].argmin()]] = enter
    chances = np.maximum(np.linalg.solve(rows[:, basis], np.append(p, 1.0)), 0.0)
    return basis, chances / chances.sum()


def _land(sizes: list[int], p: list[float], left: list[int], chance: float) -> None:
    """Decides ``left`` (``LANDING`` at most) together."""
    if not left:
        return
    own, probability = np.array([sizes[i] for i in left], float), np.array([p[i] for i in left])
    outcomes = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = outcomes - probability
    miss = np.abs(off @ own) + DOCUMENT * max(1.0, own.mean()) * np.abs(off.sum(axis=1))
    numbers, chances = _least_on_average(outcomes, miss, probability)
    chosen = outcomes[numbers[min(np.searchsorted(np.cumsum(chances), chance, side="right"), len(numbers) - 1)]]
    for i, taken in zip(left, chosen, strict=True):
        p[i] = float(taken)


def _decide(block: pd.DataFrame) -> pd.DataFrame:
    """The largest documents wait for the landing: decided alone, each could miss by its whole size."""
    block = block.sort_values(["_size", "_order", "_nth", "_p"], kind="stable")
    sizes, p = block["_size"].tolist(), block["_p"].tolist()
    seed = [int(block["_order"].min()) & 0xFFFFFFFF, len(block)]
    chances = iter(np.random.default_rng(seed).random(2 * len(p) + 2).tolist())
    first = max(0, len(p) - (LANDING - 2))
    left = _flight(sizes, p, lambda: next(chances), list(range(first))) + list(range(first, len(p)))
    if block["_blocks"].iloc[0] == 1:
        _land(sizes, p, left, next(chances))
    return block.assign(_p=p)[["_row", "source", "_order", "_nth", "_size", "_p"]]


def _decided(units: DataFrame) -> DataFrame:
    """``(_row, _p)`` with every ``_p`` 0 or 1."""
    done, level = [], 0
    open_units = units.where("_p > 0 AND _p < 1")
    settled = units.where("_p <= 0 OR _p >= 1")
    while True:
        done.append(settled.select("_row", "_p"))
        counts = keep(open_units.groupBy("source").agg(F.count(F.lit(1)).alias("_n")), "counts")
        if counts.isEmpty():
            break
        counts = counts.select(
            F.col("source").alias("_source"), F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks")
        )
        rows = open_units.join(counts, open_units["source"].eqNullSafe(counts["_source"]))
        spread = F.pmod(F.xxhash64(F.lit(level), "_order", "_nth", "_size"), F.col("_blocks"))
        moved = rows.withColumn("_block", spread).groupBy("source", "_block").applyInPandas(_decide, _UNITS)
        moved = keep(moved, f"flight-{level}")
        settled = moved.where("_p <= 0 OR _p >= 1")
        open_units = moved.where("_p > 0 AND _p < 1")
        level += 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def mix(
    rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """How often each row is taken.

    ``rows``: ``_row`` (unique), ``source``, ``_order`` (a hash that reruns repeat), ``_size``.
    Added: ``source_size``, ``target`` and ``copies``.
    """
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    wanted = keep(targets(sizes, weights, share, most), "targets").withColumnRenamed("source", "_name")
    units = rows.join(wanted, rows["source"].eqNullSafe(wanted["_name"])).drop("_name")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(times + _NEAR)
    units = units.withColumn("_whole", whole)
    fraction = F.when(times - F.col("_whole") > _NEAR, times - F.col("_whole")).otherwise(0.0)
    units = keep(units.withColumn("_p", fraction), "units")
    numbered = repeats.with_number(units.select("_row", "source", "_order", "_size", "_p"), ["source", "_order"])
    decided = _decided(numbered)
    found = units.drop("_p").join(decided, "_row")
    return found.withColumn("copies", F.col("_whole") + F.col("_p").cast("long")).drop("_whole", "_p")


def with_rows(docs: DataFrame) -> DataFrame:
    """A kept table of ``docs`` in which each row has a number."""
    return keep(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def units_of(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "_row",
        "doc_id",
        "source",
        F.xxhash64("doc_id", "text").alias("_order"),
        n_words(F.col("text")).alias("_size"),
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    numbered = with_rows(docs)
    taken = mix(units_of(numbered).drop("doc_id"), **how).where("copies > 0").select("_row", "copies")
    taken = taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
    return numbered.join(taken, "_row").select(*docs.columns)
