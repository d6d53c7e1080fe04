import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import vector_codes
from tallyhouse.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, n_parts=8, n_entries=16, rounds=6, scale=4096):
    """Every entry is evaluated for every part, in whole numbers of Python."""
    used = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = -(-max((len(v) for _, v, _ in used), default=0) // n_parts)
    cut = []
    for _, v, _ in used:
        filled = v + [0] * (width * n_parts - len(v))
        cut.append([filled[m * width : (m + 1) * width] for m in range(n_parts)])
    first = sorted(range(len(used)), key=lambda r: (used[r][0] is None, used[r][0] or 0, used[r][1]))[:n_entries]
    books = [[cut[r][m] for r in first] for m in range(n_parts)]

    def nearest(part, entries):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(entries))

    for _ in range(rounds):
        for m, entries in enumerate(books):
            own = [nearest(parts[m], entries)[1] for parts in cut]
            for k in range(len(entries)):
                mine = [parts[m] for parts, o in zip(cut, own) if o == k]
                if mine:
                    entries[k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = []
    for (i, _, label), parts in zip(used, cut):
        hits = [nearest(p, books[m]) for m, p in enumerate(parts)]
        found.append((i, "".join(f"{k:02x}" for _, k in hits), sum(d for d, _ in hits), label))
    flat = ",".join(str(x) for entries in books for e in entries for x in e)
    return found, hashlib.sha256(flat.encode()).hexdigest()


def answer(codes):
    rows = [(r.vec_id, r.code, r.error, r.label) for r in codes.rows.collect()]
    return sorted(rows, key=str), codes.digest()


def _checked(spark, rows, **options):
    codes = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), **options)
    found, books = brute(rows, **options)
    assert answer(codes) == (sorted(found, key=str), books)
    return codes


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 16))
    vectors = np.round(centres[rng.integers(0, 9, 300)] + rng.normal(size=(300, 16)) / 8, 2).astype("f4")
    rows = [(int(i), [float(x) for x in v], int(i % 3)) for i, v in enumerate(vectors)]
    rows += [(500 + i, rows[7][1], None) for i in range(20)]  # copies
    rows += [(7, rows[7][1], 1), (None, rows[9][1], 2), (900, [0.0] * 16, 1)]
    rows += [(901, None, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [0.0] * 15, 1)]
    rows += [(904, [None] + [0.0] * 15, 1)]
    codes = _checked(spark, rows)
    every = 6 * 324 * 8 * 16
    assert sum(codes.evaluated) < every / 2  # the bounds spare most evaluations


def test_few_rows_and_uneven_parts(spark):
    rows = [(i, [float(i), -1.5, 0.25 * i, 2.0, -float(i)], 0) for i in (4, 2, 9)]
    _checked(spark, rows, n_parts=3, n_entries=16, rounds=2)
    _checked(spark, rows, n_parts=8, n_entries=2, rounds=3)


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)]):
        codes = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
        assert codes.rows.collect() == [] and codes.rows.columns == ["vec_id", "label", "code", "error"]


def test_other_dimensions_and_clashing_columns(spark):
    rows = [(1, [1.0, 2.0], 3, "x"), (2, [3.0, 1.0], 3, "y"), (3, [1.0], 3, "z"), (4, [5000.0, 1.0], 3, "w")]
    docs = spark.createDataFrame(rows, SCHEMA + ", part string")
    found = vector_codes.compress(docs, n_parts=2).rows.orderBy("vec_id").collect()
    assert [(r.vec_id, r.part, r.code, r.error) for r in found] == [(1, "x", "0000", 0), (2, "y", "0101", 0)]


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10**6), st.integers(1, 20), st.sampled_from([1, 3, 1 << 23]))
def test_bounds_never_change_the_nearest(seed, k, size):
    rng = np.random.default_rng(seed)
    parts = rng.integers(-size, size + 1, (40, 2, 4))
    books = rng.integers(-size, size + 1, (2, k, 4))
    pivots = vector_codes.choose_pivots(rng.integers(-size, size + 1, (2, k, 4)))
    far = np.sqrt(((parts[:, :, None] - pivots[None]) ** 2).sum(-1)).astype("f4")
    entry, squared, _ = vector_codes.nearest_entries(parts, far, pivots, books)
    every = ((parts[:, :, None] - books[None]) ** 2).sum(-1)
    assert (entry == every.argmin(-1)).all() and (squared == every.min(-1)).all()


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_the_query_equals_its_sql(spark, folder):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    found = QUERIES["op12_vector_codes"](spark, folder)
    expected = duckdb.sql(f"SELECT {', '.join(found.columns)} FROM ({ORACLES['op12_vector_codes']})").fetchall()
    assert len(expected) and sorted(map(tuple, found.collect())) == sorted(expected)
