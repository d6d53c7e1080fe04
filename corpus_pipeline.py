"""From raw documents to packed training sequences, one dealt operator a stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet
to the shared scratch folder and hands what it reads back to the next stage. When a stage begins,
what the one before it returned has been written, so the scratch tables of that stage are deleted.
Columns other than those of ``documents`` are not passed on.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import scratch
from tallyhouse.llm import line_dedup, mixing, packing, quality, simhash
from tallyhouse.llm.words import n_words
from tallyhouse.scratch import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clearing(build: Stage, before: list[str]) -> Stage:
    """``build``, which first deletes the scratch tables ``before`` of the last stage and then lists its own there."""

    @wraps(build)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        root = f"{scratch.root(spark)}/"  # another session may have had another one
        scratch.delete(spark, [p for p in before if p.startswith(root)])
        before.clear()
        with scratch.recorded() as paths:
            result = build(spark, docs, sf_dir)
        before.extend(paths)
        return result

    return begun


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their language's thresholds."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(docs.select(*COLUMNS), labels).where(F.col("kept")).select(*COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines held by five documents and more stay in the largest of them only."""
    kept = line_dedup.deduplicate(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes it."""
    return mixing.mixed(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's words, with one end mark, in training sequences."""
    lengths = docs.select("doc_id", (n_words(F.col("text")) + 1).alias("length"))
    return packing.packed(keep(lengths, "lengths"))


_STEPS = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def stages() -> list[tuple[str, Stage]]:
    """The stages of one pipeline; another one has its own list of tables to delete."""
    before: list[str] = []
    return [(name, clearing(step, before)) for name, step in _STEPS]


#: For callers that write the tables between the stages themselves, one pipeline at a time.
STAGES = stages()

#: The thresholds and fingerprints have no SQL counterpart; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in stages():
        docs = keep(step(spark, docs, sf_dir), name)
    return docs
