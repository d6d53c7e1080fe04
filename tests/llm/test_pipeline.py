"""The stages on planted documents, and the queries' SQL beside them."""

import duckdb
import pytest

import corpus_pipeline
from tallyhouse.llm.queries import ORACLES, QUERIES
from tallyhouse.scratch import keep

FOLDER = "/root/testdata/sf0.001"
LINE = "a passage that stands in many documents and that is long enough to count"


def _words(seed, n=120):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 99991}" for i in range(n))


@pytest.fixture
def tables(spark, documents, tmp_path):
    rows = [(i, _words(i) + "\n" + LINE, "en", f"s{i % 3}", 0) for i in range(40)]
    rows += [(100 + i, rows[5][1], "en", "s0", 0) for i in range(4)]  # copies
    rows += [(200, "too short", "en", "s1", 0), (201, None, "en", "s1", 0), (202, "again and again " * 90, "en", "s2", 0)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages(spark, tables):
    docs, seen = spark.read.parquet(f"{tables}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, tables), name)
        seen[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
    ids = {name: sorted(r.doc_id for r in rows) for name, rows in seen.items()}
    assert ids["quality_rules"] == [*range(40), 100, 101, 102, 103]
    assert [r.doc_id for r in seen["line_dedup"] if LINE in r.text] == [103]
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"])
    assert len(set(ids["simhash_near_dedup"])) == len(ids["simhash_near_dedup"])
    assert set(range(40)) <= set(ids["simhash_near_dedup"])
    assert set(ids["mixing"]) <= set(ids["simhash_near_dedup"])
    assert ids["best_fit_packing"] == ids["mixing"]
    lengths = sorted(len(r.text.split()) + 1 for r in seen["mixing"])
    assert lengths == sorted(r.length for r in seen["best_fit_packing"])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    for table in ("documents", "labels", "pages", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = QUERIES[name](spark, FOLDER)
    expected = duckdb.sql(f"SELECT {', '.join(found.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
