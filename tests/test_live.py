"""The landing as a stream, and facts by buckets."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import HEADER, dimensions_of, golden_sales, plan_of, rows_of
from tallyhouse.operators.enrich import customer_columns, join_customer
from tallyhouse.sinks import buckets
from tallyhouse.streaming import ingest, live
from tallyhouse.streaming.state import State

ROW = "1,121,sugar,2023-03-03,1,50,2,100"


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        store = str(tmp_path / "store")

        def drop(self, name, *lines, age=0):
            path = tmp_path / "landing" / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("".join(line + "\n" for line in lines))
            at = 1_700_000_000 - age
            os.utime(path, (at, at))

        def run(self, checkpoint="one", **options):
            return live.ingest_stream(
                spark, str(tmp_path / "landing"), self.store, str(tmp_path / checkpoint), **options
            )

        def totals(self):
            return rows_of(ingest.accepted_sales(spark, self.store), "file_name", "total_cost")

    return Place()


def test_each_file_once_whatever_its_age_and_checkpoint(place):
    place.drop("a.csv", HEADER, ROW)
    assert place.run() == 1
    place.drop("late.csv", HEADER, ROW, age=400 * 86400)
    place.drop("b.csv", HEADER, ROW)
    assert place.run(sweep=False) == 1
    assert place.run(sweep=False) == 0
    assert place.run("two") == 0
    assert [name for name, _ in place.totals()] == ["a.csv", "b.csv", "late.csv"]


def test_the_sweep_lands_what_a_stream_does_not_hand_out(place, spark):
    place.drop("a.csv", HEADER, ROW)
    place.run()
    place.drop("a.csv", HEADER, ROW, ROW, age=-60)  # corrected in place
    place.drop("zero.csv")
    assert place.run(sweep=False) == 0
    assert place.run() == 1
    assert len(place.totals()) == 2
    files = ingest.landed_files(spark, place.store)
    assert rows_of(files.where("length = 0"), "file_name") == [("zero.csv",)]


def test_a_micro_batch_that_failed_runs_again(place, spark):
    place.drop("a.csv", HEADER, ROW)

    def lost(*arguments):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        place.run(after_batch=lost)
    assert State(spark, place.store).last == -1
    assert place.run() == 1 and len(place.totals()) == 1


def test_small_micro_batches(place, spark):
    for n in range(5):
        place.drop(f"{n}.csv", HEADER, ROW)
    assert place.run(files_per_batch=2) == 3
    assert len(place.totals()) == 5


def test_a_join_by_buckets_moves_no_sale(spark, tmp_path):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = spark.conf.get(names[0])
    path, sales = str(tmp_path / "facts"), golden_sales(spark)
    for load in (sales.where("store_id = 121"), sales.where("store_id <> 121 OR store_id IS NULL")):
        buckets.add(load, path, "customer_id", 8)
    facts = buckets.read(spark, path, sales.schema, "customer_id", 8)
    customers = dimensions_of(spark)[0]
    try:
        for name in names:
            spark.conf.set(name, "-1")
        joined = buckets.join(facts, customer_columns(customers), "customer_id")
        wanted = join_customer(sales, customers)
        assert rows_of(joined, *wanted.columns) == rows_of(wanted)
        plan = plan_of(joined).split("Initial Plan")[0]
        scan = plan.index("FileScan parquet")
        above = plan[:scan].splitlines()
        assert "SortMergeJoin" in plan and not any("Exchange" in x for x in above)
        assert plan.count("Exchange hashpartitioning") == 1  # of the customers
    finally:
        spark.conf.set(names[0], before)
        spark.conf.unset(names[1])


def test_a_hot_key_lies_in_several_buckets(spark, tmp_path):
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("v"))
    buckets.add(rows, str(tmp_path / "hot"), "k", 16)
    held = [p for p in (tmp_path / "hot").glob("*.parquet")]
    assert len(held) > 3
    assert buckets.read(spark, str(tmp_path / "hot"), rows.schema, "k", 16).count() == 4000
