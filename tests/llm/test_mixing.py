from collections import Counter

import pytest

from tallyhouse.llm import mixing


def _mix(docs):
    return mixing.mix(mixing.units_of(mixing.with_rows(docs))).collect()


def _targets(sizes):
    """Caps and reshares one round after another."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    rest, free, done = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        each = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if each[s] > 2 * sizes[s]}
        if not over:
            return done | each
        done |= {s: 2.0 * sizes[s] for s in over}
        rest -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return done


def test_targets_are_met(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)
    names = ["a", "b", "c", "Z", None, "é"]
    rows = [(i, "w " * (1 + i * 37 % 91), "en", names[0] if i % 3 == 0 else names[i % 6], 0) for i in range(1500)]
    taken, sizes, wanted, longest = Counter(), Counter(), {}, 0
    for r in _mix(documents(rows)):
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r._size
        sizes[r.source] += r._size
        wanted[r.source] = r.target
        longest = max(longest, r._size)
    for source, target in _targets(sizes).items():
        assert wanted[source] == pytest.approx(target)
        assert abs(taken[source] - target) <= 2 * longest


def test_reruns_agree(documents):
    rows = [(i, "w " * (i % 13), "en", "ab"[i % 2], 0) for i in range(300)]
    one = sorted((r.doc_id, r.copies) for r in _mix(documents(rows)))
    two = sorted((r.doc_id, r.copies) for r in _mix(documents(rows[::-1]).repartition(7)))
    assert one == two


def test_inclusion_keeps_its_probability():
    import numpy as np

    sizes, total = [3, 3, 5, 9, 9, 1, 20], np.zeros(7)
    for seed in range(3000):
        rng = np.random.default_rng(seed)
        p = [0.3] * 7
        left = mixing._flight(sizes, p, rng.random)
        mixing._land(sizes, p, left, rng.random())
        assert set(p) <= {0.0, 1.0}
        total += p
    assert np.abs(total / 3000 - 0.3).max() < 0.04


def test_mixed_rows_and_odd_ones(documents):
    rows = [(1, None), (None, "a b"), (None, "a b"), (2, ""), (3, "c"), (3, "c")]
    docs = documents(rows)
    found = mixing.mixed(docs)
    assert found.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in found.collect())
    assert abs(words - 9) <= 4
    assert mixing.mixed(documents([])).count() == 0
    assert mixing.mixed(documents([(1, None), (2, "")])).count() == 0


def test_clashing_columns_pass_through(documents):
    from pyspark.sql import functions as F

    docs = documents([(i, "x y z") for i in range(40)]).withColumns({"size": F.lit(1), "copies": F.lit("c"), "target": F.lit(2)})
    found = mixing.mixed(docs)
    assert found.columns == docs.columns
    assert found.where("copies = 'c'").count() == found.count() == 60


def test_landing_keeps_margins_and_misses_least_on_average():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(40):
        k = int(rng.integers(1, 8))
        p = rng.choice([0.25, 0.5, 0.7, 0.9], k) if rng.random() < 0.5 else rng.random(k)
        sizes = rng.integers(1, 200, k)
        outcomes = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1
        miss = np.abs((outcomes - p) @ sizes)
        numbers, chances = mixing._least_on_average(outcomes, miss, p)
        assert chances @ outcomes[numbers] == pytest.approx(p) and chances.min() >= 0
        found = chances @ miss[numbers]
        # No other outcome lowers the average at the prices of the basis: that proves it least.
        rows = np.vstack([outcomes.T, np.ones(len(outcomes))]).astype(float)
        prices = np.linalg.solve(rows[:, numbers].T, miss[numbers])
        assert prices @ np.append(p, 1.0) == pytest.approx(found, abs=1e-6)
        assert (miss - prices @ rows).min() > -1e-6


def test_a_dozen_documents_land_near(documents):
    rows = [(i, "w " * (5 + (i * i * 7919) % 700), "en", f"s{i % 4}", 0) for i in range(200)]
    found = _mix(documents(rows))
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.copies * r._size for r in own) - own[0].target) < 0.03 * own[0].target


def test_equal_rows_are_spread_over_blocks(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)
    sizes = []
    inner = mixing._decide

    def noted(block):
        with open(noted.path, "a") as f:
            f.write(f"{len(block)}\n")
        return inner(block)

    import tempfile

    noted.path = tempfile.mktemp()
    monkeypatch.setattr(mixing, "_decide", noted)
    rows = [(None, "w w w", "en", "a", 0)] * 5000 + [(i, "w " * (i % 9), "en", "b", 0) for i in range(1000)]
    found = _mix(documents(rows))
    sizes = [int(x) for x in open(noted.path)]
    assert max(sizes) < 200
    taken = sum(r.copies * r._size for r in found if r.source == "a")
    assert abs(taken - found[0].target if found[0].source == "a" else 0) <= 6
    again = _mix(documents(rows[::-1]).repartition(5))

    def outcome(rows):
        return sorted((r.source, r.doc_id or -1, r.copies) for r in rows)

    assert outcome(found) == outcome(again)
