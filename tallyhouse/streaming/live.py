"""The landing as a stream: files are landed as they arrive, the store still decides what is new.

Spark's file stream finds files and remembers in its checkpoint which it has handed out; each
micro-batch becomes a batch of the store. What the checkpoint says is never trusted alone: a micro-batch
that comes again after a crash, or under a new checkpoint, lands only what the store lacks.

A file stream knows a file by its path, so it hands out no file that was corrected in place, nor files of
zero bytes. ``sweep`` lists the landing once after the stream has caught up and lands those; the stream's
own age limit is set out of the way.
"""

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.schemas import INVENTORY, LONG, TEXT, TIME, table
from tallyhouse.scratch import delete, keep, recorded
from tallyhouse.streaming.ingest import AfterBatch, finish, ingest, land_batch, new_files
from tallyhouse.streaming.state import State

#: The columns that Spark's source of whole files has; the content is never read.
_WHOLE_FILES = table(path=TEXT, modificationTime=TIME, length=LONG, content=T.BinaryType())
_ANY_AGE = "36500d"


def arriving(spark: SparkSession, landing: str, files_per_batch: int) -> DataFrame:
    """Every file below ``landing`` as a stream, oldest first."""
    stream = spark.readStream.format("binaryFile").schema(_WHOLE_FILES)
    stream = stream.option("recursiveFileLookup", True).option("maxFileAge", _ANY_AGE)
    return stream.option("maxFilesPerTrigger", files_per_batch).load(landing).select(*INVENTORY.names)


def start(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    *,
    files_per_batch: int = 1000,
    every: str | None = None,
    how: str = "heads",
    after_batch: AfterBatch | None = None,
    replace: bool = True,
    check_total: bool = False,
    compact_every: int | None = 20,
) -> StreamingQuery:
    """Lands what is there and stops, or, with ``every`` (as '1 minute'), goes on until it is stopped."""

    def land(files: DataFrame, micro_batch: int) -> None:
        session = files.sparkSession
        state = State(session, store)
        with recorded() as scratch:
            listing = keep(new_files(files, state), "listing")
            if not listing.isEmpty():
                land_batch(listing, state, how, replace, check_total)
                if after_batch:
                    after_batch(session, store, state.last + 1)
                finish(session, store, state.last + 1, compact_every)
        delete(session, scratch)

    writer = arriving(spark, landing, files_per_batch).writeStream.foreachBatch(land)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingest_stream(
    spark: SparkSession, landing: str, store: str, checkpoint: str, *, sweep: bool = True, **options
) -> int:
    """Lands everything that has arrived; returns how many batches. Options are those of ``start``."""
    first = State(spark, store).last
    start(spark, landing, store, checkpoint, **options).awaitTermination()
    if sweep:
        options.pop("every", None)
        ingest(spark, landing, store, **options)
    return State(spark, store).last - first
