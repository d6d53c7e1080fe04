"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the longest permitted sequence are cut into pieces, none of whose tokens
are lost. Pieces are dealt into blocks by a hash and each block is packed by itself, longest
piece first: a piece goes to the open bin it fits best, whatever that bin's size. If it fits
none, a bin is opened. Its size is the one of least cost per token that is expected in it: the
piece and, up to the room beside it, the block's shorter pieces that are still to come. A
sequence costs ``per_sequence`` plus its tokens plus their square over ``attention``. At the end
each bin shrinks to the shortest permitted length that holds its contents.

Equal rows are numbered first, so that repeated ones and those with NULL ids spread over all blocks.
A block leaves a bin or two underfilled, and holds ``BLOCK`` pieces, so the loss is small and
does not grow with the data. Blocks are packed in parallel and see nothing of each other.

Defined cases: lengths below one are taken as one (an empty document still has its end mark);
NULL lengths likewise; repeated rows are packed as often as they come; NULL ids are ordinary.
"""

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm import repeats

BLOCK = 4096
_PACKED = "doc_id long, piece int, length long, sequence string, start long, capacity long"


@dataclass(frozen=True)
class Bins:
    lengths: tuple[int, ...] = (512, 1024, 2048, 4096, 8192)
    per_sequence: float = 128.0
    attention: float = 32768.0

    def cost(self, length: int) -> float:
        return self.per_sequence + length + length * length / self.attention

    def opened(self, piece: int, shorter: np.ndarray, sums: np.ndarray) -> int:
        """``shorter``: ascending lengths still to come; ``sums``: their running totals from 0."""

        def per_token(length: int) -> float:
            room = length - piece
            coming = sums[np.searchsorted(shorter, room, side="right")]
            return self.cost(length) / (piece + min(room, coming))

        return min((c for c in self.lengths if c >= piece), key=lambda c: (per_token(c), c))

    def shrunk(self, content: int) -> int:
        return min(c for c in self.lengths if c >= content)


def pack(lengths: list[int], bins: Bins) -> tuple[list[int], list[int], list[int]]:
    """Bin, start and final capacity of each piece; ``lengths`` must descend."""
    ascending = np.array(lengths[::-1], np.int64)
    sums = np.concatenate([[0], np.cumsum(ascending)])
    room: list[tuple[int, int]] = []  # of open bins, ascending
    content: list[int] = []
    placed, starts = [], []
    for i, length in enumerate(lengths):
        at = bisect_left(room, (length, -1))
        if at < len(room):
            left, number = room.pop(at)
        else:
            to_come = len(lengths) - i - 1
            left = bins.opened(length, ascending[:to_come], sums)
            number = len(content)
            content.append(0)
        placed.append(number)
        starts.append(content[number])
        content[number] += length
        if left > length:
            insort(room, (left - length, number))
    capacity = [bins.shrunk(c) for c in content]
    return placed, starts, [capacity[b] for b in placed]


def _packed(bins: Bins):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "_order", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable"
        )
        placed, starts, capacity = pack(rows["length"].tolist(), bins)
        number = rows["_block"].iloc[0]
        names = [f"{number}-{b}" for b in placed]
        return rows.assign(sequence=names, start=starts, capacity=capacity)[
            ["doc_id", "piece", "length", "sequence", "start", "capacity"]
        ].convert_dtypes(convert_string=False)

    return block


def packed(docs: DataFrame, bins: Bins = Bins()) -> DataFrame:
    """One row per piece of the rows of ``docs`` (``doc_id``, ``length``).

    ``sequence`` names a bin, ``start`` is where the piece begins in it, and ``capacity`` is
    the length of the sequence.
    """
    longest = max(bins.lengths)
    length = F.greatest(F.coalesce(F.col("length").cast("long"), F.lit(1)), F.lit(1))
    rows = repeats.with_number(docs.select("doc_id", length.alias("_whole")), ["doc_id", "_whole"])
    last = F.floor((F.col("_whole") - 1) / longest).cast("int")
    pieces = rows.select("doc_id", "_whole", "_nth", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    rest = F.least(F.col("_whole") - F.col("piece").cast("long") * longest, F.lit(longest))
    pieces = pieces.select(
        "doc_id", "piece", rest.alias("length"), F.xxhash64("doc_id", "_whole", "_nth", "piece").alias("_order")
    )
    blocks = max(1, -(-pieces.count() // BLOCK))
    dealt = pieces.withColumn("_block", F.pmod("_order", F.lit(blocks)))
    return dealt.groupBy("_block").applyInPandas(_packed(bins), _PACKED)
