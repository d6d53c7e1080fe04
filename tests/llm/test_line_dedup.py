from collections import Counter, defaultdict
from hashlib import md5

import numpy as np
import pytest

from tallyhouse.llm import cuckoo, line_dedup

LONG = "this line is long enough to be looked at, number "
LOWER = {c: c + 32 for c in range(65, 91)}


def _keys(n, salt=""):
    return np.frombuffer(b"".join(md5(f"{salt}{i}".encode()).digest() for i in range(n)), np.uint8).reshape(-1, 16)


def test_filter_insertion_and_deletion():
    shard = cuckoo.Shard.empty(5000)
    keys = _keys(5000)
    shard.insert(keys)
    assert shard.contains(keys).all()
    assert cuckoo.Shard.from_bytes(shard.to_bytes()).contains(keys).all()
    assert shard.contains(_keys(5000, "other")).mean() < 0.01
    shard.delete(keys[:3000])
    assert shard.contains(keys[3000:]).all()
    assert shard.contains(keys[:3000]).mean() < 0.01
    shard.insert(keys[:3000])
    assert shard.contains(keys).all()


def test_marks_do_not_repeat_the_shard():
    """With 4,096 shards the keys of one share their first bytes; false positives stay rare."""
    keys = _keys(400_000)
    number = (keys[:, 0].astype(int) * 256 + keys[:, 1]) % 4096
    others = _keys(400_000, "other")
    elsewhere = (others[:, 0].astype(int) * 256 + others[:, 1]) % 4096
    wrong = tried = 0
    for shard in range(0, 4096, 64):
        filled = cuckoo.Shard.empty((number == shard).sum())
        filled.insert(keys[number == shard])
        passed = filled.contains(others[elsewhere == shard])
        wrong, tried = wrong + passed.sum(), tried + len(passed)
    assert tried > 5000 and wrong / tried < 0.001


def test_a_full_filter_says_so():
    with pytest.raises(cuckoo.Full):
        cuckoo.Shard.empty(1).insert(_keys(200))


def _brute(rows, min_docs=5):
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if len(key) >= 40:
                held[key].add(doc_id)
    last = {k: max((d for d in ids if d is not None), default=None) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if last.get(k, doc_id) in (doc_id, None)]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def _rows(n, salt=0):
    rng = np.random.default_rng(salt)
    rows = []
    for i in range(n):
        picked = rng.integers(0, 12, rng.integers(0, 9))
        lines = [f"  {LONG.upper() if rng.random() < 0.3 else LONG}{p}\t" for p in picked] + [f"short {i}"]
        rows.append((i + 1000 * salt, "\n".join(lines)))
    return rows


def _result(df):
    return Counter((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in df.collect())


def test_against_brute_force(documents):
    rows = _rows(60)
    rows += [(7, rows[7][1]), (500, None), (501, ""), (None, LONG + "1"), (502, (LONG + "2\n") * 3000), (503, "\x0b" + LONG + "3\r")]
    assert _result(line_dedup.deduplicate(documents(rows))) == _brute(rows)


@pytest.mark.parametrize("most", [line_dedup.MOST_FILTER_BYTES, 0])
def test_batches_and_deletions_can_be_taken_back(spark, documents, tmp_path, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "MOST_FILTER_BYTES", most)
    one, two = _rows(25), _rows(25, salt=1)
    store = line_dedup.LineStore(spark, str(tmp_path / "lines"))
    store.insert(documents(one))
    alone = _result(store.without_repeats(documents(one)))
    assert alone == _brute(one)
    store.insert(documents(two))
    assert _result(store.without_repeats(documents(one + two))) == _brute(one + two)
    store = line_dedup.LineStore.reopened(spark, str(tmp_path / "lines"))
    assert store.batches == 2
    store.delete(documents(two))
    assert _result(store.without_repeats(documents(one))) == alone
    store.delete(documents(one))
    assert _result(store.without_repeats(documents(one))) == Counter({(d, t or "", len(t.split("\n")), 0): 1 for d, t in one})


def test_empty_table_and_clashing_columns(documents):
    assert line_dedup.deduplicate(documents([])).count() == 0
    docs = documents([(i, LONG) for i in range(6)]).withColumnRenamed("source", "n_lines").withColumnRenamed("lang", "key")
    found = line_dedup.deduplicate(docs).orderBy("doc_id").collect()
    assert [(r.n_lines, r.n_dropped, r.text) for r in found] == [(1, 1, "")] * 5 + [(1, 0, LONG)]
    assert found[0].key == "en"
