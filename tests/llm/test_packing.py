from collections import Counter, defaultdict

from hypothesis import given, strategies as st

from tallyhouse.llm import packing
from tallyhouse.llm.packing import Bins

SMALL = Bins(lengths=(8, 16, 32), per_sequence=2.0, attention=64.0)


def _best_fit(lengths, bins):
    """The same by looking at every bin for every piece."""
    open_bins, content, placed = [], [], []
    for i, length in enumerate(lengths):
        fitting = [(left, b) for b, left in enumerate(open_bins) if left >= length]
        if fitting:
            _, chosen = min(fitting)
        else:
            later = sorted(lengths[i + 1 :])

            def per_token(c, length=length, later=later):
                coming = sum(x for x in later if x <= c - length)
                return bins.cost(c) / (length + min(c - length, coming))

            size = min((c for c in bins.lengths if c >= length), key=lambda c: (per_token(c), c))
            chosen = len(open_bins)
            open_bins.append(size)
            content.append(0)
        placed.append(chosen)
        open_bins[chosen] -= length
        content[chosen] += length
    return placed, [min(c for c in bins.lengths if c >= content[b]) for b in placed]


@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit(lengths):
    lengths.sort(reverse=True)
    placed, starts, capacity = packing.pack(lengths, SMALL)
    assert (placed, capacity) == _best_fit(lengths, SMALL)
    filled = Counter()
    for b, start, length in zip(placed, starts, lengths, strict=True):
        assert start == filled[b]
        filled[b] += length


def test_least_cost_decides_on_the_size():
    assert packing.pack([8] * 4, Bins((8, 32), per_sequence=100.0, attention=1e9))[2] == [32] * 4
    assert packing.pack([8] * 4, Bins((8, 32), per_sequence=0.0, attention=8.0))[2] == [8] * 4
    assert packing.pack([3], Bins((8, 32), per_sequence=100.0, attention=1e9))[2] == [8]


def test_no_token_is_lost(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 64)
    rows = [(i, i * 17 % 90) for i in range(500)] + [(3, 51)] * 5 + [(None, 7), (9, None), (8, 0), (7, 100_000)]
    found = packing.packed(spark.createDataFrame(rows, "doc_id long, length int"), SMALL).collect()
    wanted = sum(max(1, n or 0) for _, n in rows)
    assert sum(r.length for r in found) == wanted
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence].append(r)
    for pieces in bins.values():
        pieces.sort(key=lambda r: r.start)
        ends = [r.start + r.length for r in pieces]
        assert [r.start for r in pieces] == [0, *ends[:-1]]
        assert len({r.capacity for r in pieces}) == 1
        assert pieces[0].capacity == SMALL.shrunk(ends[-1])
    long = sorted(r.piece for r in found if r.doc_id == 7 and r.length == 32)
    assert long == list(range(3125))
    assert sum(r.capacity for p in bins.values() for r in p[:1]) < 1.05 * wanted


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([], "doc_id long, length long, sequence string")
    assert packing.packed(df).count() == 0
    one = packing.packed(spark.createDataFrame([(1, 5, "s")], "doc_id long, length long, sequence string")).first()
    assert (one.sequence, one.start, one.capacity) == ("0-0", 0, 512)


def test_equal_rows_are_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 256)
    rows = [(None, 5)] * 6000 + [(i, 7) for i in range(600)]
    found = packing.packed(spark.createDataFrame(rows, "doc_id long, length int"), SMALL).collect()
    assert len(found) == 6600
    per_block = Counter(r.sequence.split("-")[0] for r in found)
    assert max(per_block.values()) < 2 * 256
