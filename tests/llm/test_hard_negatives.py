import math

import duckdb
import numpy as np
import pytest

from tallyhouse.llm import hard_negatives
from tallyhouse.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"
IS_ANCHOR = "vec_id % 5 = 0"


def brute(rows, n_positives=5, n_negatives=3):
    used = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = (label, [math.floor(256 * x) for x in v])
        used[i] = min(used.get(i, one), one)
    found = []
    for anchor in (i for i in used if i % 5 == 0):
        label, v = used[anchor]
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, (_, w) in used.items() if i != anchor)
        for s, positive in [x for x in scored if used[x[1]][0] == label][:n_positives]:
            fits = [x for x in scored if used[x[1]][0] != label and 50 * -s <= 100 * -x[0] <= 95 * -s]
            for rank, (t, negative) in enumerate(fits[:n_negatives], 1):
                found.append((anchor, positive, rank, negative, -s, -t))
    return sorted(found)


def mined(spark, rows):
    return hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), IS_ANCHOR)


def clustered(n, dims, seed=5):
    """Labels that mostly follow directions, so that bounds end walks early."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims)) * 4
    own = rng.integers(0, 6, n)
    vectors = (centres[own] + rng.normal(size=(n, dims))).astype("f4")
    labels = np.where(rng.random(n) < 0.2, rng.integers(0, 6, n), own)
    return [(int(i), [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels))]


def test_equals_brute_force(spark, monkeypatch):
    for name, value in (("ANCHORS_PER_CLUSTER", 8), ("BLOCK", 50), ("QUERY_BLOCK", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(400, 8)
    rows += [(1000 + i, rows[10][1], i % 2) for i in range(30)]  # ties
    rows += [(20, rows[20][1], 3), (None, rows[1][1], 1), (2000, [0.0] * 8, 1), (2001, rows[0][1], None)]
    rows += [(2005, None, 1), (2010, [float("nan")] * 8, 2), (2015, [None] * 8, 2), (2020, [1.0], 2)]
    found = sorted(map(tuple, mined(spark, rows).collect()))
    fits = [r for r in rows if r[0] != 2020]
    assert found == brute(fits) and len(found) > 300


def test_walks_end_early(spark, monkeypatch):
    """Members whose answer is certain leave the walk before the last segments."""
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_CLUSTER", 8)
    left = []
    whole = hard_negatives._not_certain

    def counted(members, *rest):
        still = whole(members, *rest)
        left.append((members.count(), still.count()))
        return still

    monkeypatch.setattr(hard_negatives, "_not_certain", counted)
    rng = np.random.default_rng(1)
    centres = np.eye(6) * 8
    rows = []
    for i in range(600):
        v = centres[i % 6] + rng.normal(size=6) / 2
        rows.append((i, [float(np.float32(x)) for x in v], i % 6 if i % 4 else (i + 1) % 6))
    assert sorted(map(tuple, mined(spark, rows).collect())) == brute(rows)
    assert left[0][1] < left[0][0] / 4 or left[1][1] < left[0][0] / 4


def test_small_clusters_share_a_pack(monkeypatch):
    monkeypatch.setattr(hard_negatives, "QUERY_BLOCK", 10)
    assert hard_negatives.packed({0: 4, 1: 25, 2: 6, 3: 1, 4: 5}) == [[1], [2], [4, 0, 3]]


def test_bounds_hold():
    rng = np.random.default_rng(2)
    vectors, anchors = rng.normal(size=(500, 6)) * 9, rng.normal(size=(60, 6))
    centres = hard_negatives.fit_centres(anchors, 4)
    angles, norms = hard_negatives._angles(anchors, centres)
    own = angles.argmin(axis=1)
    widest = np.array([angles[own == k, k].max(initial=0) for k in range(4)])
    bound = hard_negatives.bounds(vectors, centres, widest)
    assert (anchors @ vectors.T <= norms[:, None] * bound[:, own].T).all()


def test_large_components_are_exact():
    a = np.array([[2.0**23 - 1, 2.0**23 - 3] * 8])
    assert hard_negatives._scores(a, a)[0, 0] == sum(int(x) ** 2 for x in a[0])


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(5, [1.0, 2.0], 1)], [(5, [1.0], 1), (6, [-1.0], 1), (7, [1.0], 2)]])
def test_no_negatives(spark, rows):
    found = mined(spark, rows)
    assert found.collect() == [] and found.columns[0] == "anchor_id"


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_the_query_equals_its_sql(spark, folder):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    found = QUERIES["op13_hard_negatives"](spark, folder)
    expected = duckdb.sql(f"SELECT {', '.join(found.columns)} FROM ({ORACLES['op13_hard_negatives']})").fetchall()
    assert len(expected) and sorted(map(tuple, found.collect())) == sorted(expected)
