import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, strategies as st
from xxhash import xxh64_intdigest

from tallyhouse.llm import components, simhash

LOWER = {c: c + 32 for c in range(65, 91)}


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashed = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


@given(st.text(alphabet="aÉB \t\n\x0b\x1c ", max_size=80))
def test_fingerprints(text):
    assert simhash._fingerprint(text) % 2**64 == _fingerprint(text)


def test_any_four_positions_contain_a_set():
    sets = [set(s) for s in simhash.covering_sets()]
    assert len(sets) == 20
    assert all(any(s <= set(four) for s in sets) for four in combinations(range(8), 4))


def _roots(values):
    """Smallest member of each value's component, by all pairs."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(root), 2):
        if ((a ^ b) % 2**64).bit_count() <= 4:
            one, two = sorted((find(a), find(b)))
            root[two] = one
    return {v: find(v) for v in root}


@pytest.mark.parametrize("longest", [2048, 16])
def test_no_link_is_lost(spark, monkeypatch, longest):
    """Random fingerprints, chains, and a dense group far longer than a list may be."""
    monkeypatch.setattr(simhash, "LONGEST_LIST", longest)
    rng = np.random.default_rng(3)
    values = rng.integers(-(2**63), 2**63 - 1, 150).tolist()
    for start in values[:20]:
        for _ in range(6):
            flips = rng.choice(64, rng.integers(3, 6), replace=False)
            start = int(np.int64(start) ^ np.bitwise_xor.reduce(np.int64(1) << flips.astype(np.int64)))
            values.append(start)
    values += [int(values[30] ^ (1 << a) ^ (1 << b)) for a, b in combinations(range(0, 24, 2), 2)]
    df = spark.createDataFrame([(v,) for v in set(values)], "_fp long")
    found = components.components(simhash.links(df))
    roots = dict(found.collect())
    assert {v: roots.get(v, v) for v in values} == _roots(values)


def test_links_further_apart_are_refused(spark):
    with pytest.raises(ValueError, match="at most 4"):
        simhash.links(spark.createDataFrame([], "_fp long"), 5)


def test_components_of_a_path_and_odd_links(spark):
    rows = [(i, i + 1) for i in range(40)] + [(7, 7), (3, 4), (None, 4), (100, 99), (99, 100)]
    found = dict(components.components(spark.createDataFrame(rows, "u long, v long")).collect())
    assert found == {i: 0 for i in range(1, 41)} | {100: 99}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents(spark, documents):
    long = " ".join(f"word{i}" for i in range(4000))
    rows = [(5, "a b"), (3, "A  B"), (3, "A  B"), (9, None), (8, " \n"), (None, "a b"), (2, long), (1, long + " more"), (4, "x y z")]
    found = sorted(simhash.near_duplicates(documents(rows)).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id) for r in found] == [(1, 1), (2, 1), (3, 3), (3, 3), (4, 4), (5, 3), (8, 8), (9, 8), (None, 3)]
    assert found[6].fingerprint == "0" * 16
    assert found[0].fingerprint == f"{_fingerprint(long + ' more'):016x}"
    kept = simhash.keep_one(documents(rows))
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, i) for i in (1, 3, 4, 8)] + [(True, None)]
    assert kept.columns == documents(rows).columns
    assert simhash.near_duplicates(documents([])).count() == 0


def test_a_hot_node_is_spread(spark):
    from tallyhouse.llm import components

    star = [(0, i) for i in range(1, 4000)] + [(10_000 + i, 10_001 + i) for i in range(30)] + [(3999, 10_000)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(star, "u long, v long")).collect()}
    assert found == dict.fromkeys([*range(1, 4000), *range(10_000, 10_031)], 0)
