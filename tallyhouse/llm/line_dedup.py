"""Line dedup that can be taken back: cuckoo filters in front of exact reference counts.

A ``LineStore`` is a folder of three tables, each with one part per batch:

- ``refs``: key of a line, document, and how many of its lines have that key; negative rows
  take a deleted document's references back,
- ``counts``: for every key that the batch touched, the number of documents that hold it and
  the largest of them; the newest row of a key holds,
- ``filters``: sharded cuckoo filters over the repeated keys, those held by ``min_docs``
  documents or more. Keys that cross this count upwards are inserted, keys that fall below it
  when documents are deleted are deleted. A shard that gets full is built anew from ``counts``.

A key is the MD5 of a line stripped of white space and with A-Z lower-cased; lines shorter than
``min_chars`` code points have none. Lines of repeated keys are dropped from all documents but
the one with the largest id. To find them, references are first held against the filters, which
passes nearly nothing but repeated keys, and what passes is looked up in the exact counts, so a
false positive costs a lookup and never a line. Filters of ``MOST_FILTER_BYTES`` at most in total are
sent to all tasks; beyond that references go to the filter of their shard, a shard's references spread
over several tasks, and stream past it.

Each batch ends with its filters. One that was lost on the way is written again under the same
number, and readers see complete batches only.

Defined cases: NULL and empty texts are one empty line; a NULL id counts as one document,
smaller than all others; rows that share an id are one document, and lines kept in it stay in
all its rows; a text that loses all its lines becomes empty.
"""

from collections.abc import Iterable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.llm.cuckoo import Full, Shard
from tallyhouse.llm.words import SPACE_CHARS
from tallyhouse.scratch import folder

MOST_FILTER_BYTES = 32 << 20
KEYS_PER_SHARD = 100_000
_REFS = "key binary, doc_id long, refs long"
_COUNTS = "key binary, n_docs long, last_doc long, was_repeated boolean, batch int"
_FILTERS = "shard int, n_shards int, n_keys long, cells binary, batch int"


def _key(line: str, min_chars: int) -> bytes | None:
    line = line.strip(SPACE_CHARS)
    return md5(line.encode().lower()).digest() if len(line) >= min_chars else None


def _references(min_chars: int):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, refs = [], [], []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held: dict[bytes, int] = {}
                for line in (text or "").split("\n"):
                    key = _key(line, min_chars)
                    if key is not None:
                        held[key] = held.get(key, 0) + 1
                keys += held
                refs += held.values()
                ids += [doc_id] * len(held)
            columns = [pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(refs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "refs"])

    return of_batches


def _as_keys(values: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, 16)


def _changed_shard(changes: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    """The shard with its changes, or without cells if it must be built anew."""
    n_keys = int(old["n_keys"].sum()) if len(old) else 0
    added = _as_keys(changes["key"][changes["repeated"]])
    removed = _as_keys(changes["key"][~changes["repeated"]])
    either = changes if len(changes) else old
    shard = Shard.from_bytes(old["cells"].iloc[0]) if len(old) else Shard.empty(len(added))
    try:
        shard.delete(removed)
        shard.insert(added)
        cells = shard.to_bytes()
    except Full:
        cells = None
    n_keys += len(added) - len(removed)
    row = {"shard": either["shard"].iloc[0], "n_shards": either["n_shards"].iloc[0]}
    return pd.DataFrame([row | {"n_keys": n_keys, "cells": cells}])


def _built_shard(keys: pd.DataFrame) -> pd.DataFrame:
    room = len(keys)
    while True:
        shard = Shard.empty(room)
        try:
            shard.insert(_as_keys(keys["key"]))
            break
        except Full:
            room *= 2
    row = {"shard": keys["shard"].iloc[0], "n_shards": keys["n_shards"].iloc[0]}
    return pd.DataFrame([row | {"n_keys": len(keys), "cells": shard.to_bytes()}])


def _passing(shards: dict[int, bytes], n_shards: int):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {number: Shard.from_bytes(cells) for number, cells in shards.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _as_keys(batch.column(0).to_pylist())
            number = keys[:, 0].astype(int) * 256 + keys[:, 1]
            number %= n_shards
            passes = np.zeros(len(keys), bool)
            for shard in np.unique(number):
                own = np.flatnonzero(number == shard)
                if shard in filters:
                    passes[own] = filters[shard].contains(keys[own])
            yield batch.filter(pa.array(passes))

    return of_batches


_TO_SHARD = "shard int, salt int, place int, key binary, doc_id long, cells binary"


def _past_their_filter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by shard and salt, a filter before the references that it is to judge."""
    at, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shards, salts = batch.column("shard").to_numpy(), batch.column("salt").to_numpy()
        turns = np.flatnonzero((np.diff(shards) != 0) | (np.diff(salts) != 0)) + 1
        for run in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
            part = batch.slice(run[0], run[1] - run[0])
            if (shards[run[0]], salts[run[0]]) != at:
                at, held = (shards[run[0]], salts[run[0]]), None
            if part.column("place")[0].as_py() == 0:
                held, part = Shard.from_bytes(part.column("cells")[0].as_py()), part.slice(1)
            if part.num_rows and held is not None:
                passes = held.contains(_as_keys(part.column("key").to_pylist()))
                yield part.select(["key", "doc_id"]).filter(pa.array(passes))


class LineStore:
    def __init__(self, spark: SparkSession, path: str, min_docs: int = 5, min_chars: int = 40):
        self.spark, self.path = spark, path
        self.min_docs, self.min_chars = min_docs, min_chars
        self.batches = 0  # complete ones

    @classmethod
    def reopened(cls, spark: SparkSession, path: str, **rules: int) -> "LineStore":
        store = cls(spark, path, **rules)
        newest = spark.read.schema(_FILTERS).parquet(f"{path}/filters").agg(F.max("batch")).first()[0]
        store.batches = 0 if newest is None else newest + 1
        return store

    def insert(self, docs: DataFrame) -> None:
        found = docs.select("doc_id", "text").mapInArrow(_references(self.min_chars), _REFS)
        self._update(found.groupBy("key", "doc_id").agg(F.sum("refs").alias("refs")))

    def delete(self, ids: DataFrame) -> None:
        """Takes back all references of the documents whose ``doc_id`` is in ``ids``."""
        gone = self._refs().join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
        self._update(gone.select("key", "doc_id", (-F.col("refs")).alias("refs")))

    def _part(self, table: str) -> str:
        return f"{self.path}/{table}/batch={self.batches}"

    def _log(self, table: str, schema: str) -> DataFrame:
        whole = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        return whole.where(F.col("batch") < self.batches)

    def _refs(self) -> DataFrame:
        """References that hold, over all batches."""
        log = self._log("refs", f"{_REFS}, batch int").groupBy("key", "doc_id")
        return log.agg(F.sum("refs").alias("refs")).where("refs > 0")

    def _counts(self) -> DataFrame:
        """The newest count of each key."""
        newest = F.max(F.struct("batch", "n_docs", "last_doc")).alias("newest")
        counts = self._log("counts", _COUNTS).groupBy("key").agg(newest)
        return counts.select("key", "newest.n_docs", "newest.last_doc")

    def _update(self, delta: DataFrame) -> None:
        delta.write.mode("overwrite").parquet(self._part("refs"))
        delta = self.spark.read.schema(_REFS).parquet(self._part("refs"))
        rows = delta.select("key", "doc_id", "refs", F.lit(0).cast("long").alias("before"))
        if self.batches:
            touched = delta.select("key").distinct()
            held = self._refs().join(touched, "key", "left_semi")
            held = held.select("key", "doc_id", "refs", F.col("refs").alias("before"))
            rows = rows.unionByName(held).groupBy("key", "doc_id")
            rows = rows.agg(F.sum("refs").alias("refs"), F.sum("before").alias("before"))
        holds = F.col("refs") > 0
        counts = rows.groupBy("key").agg(
            F.count_if(holds).alias("n_docs"),
            F.max(F.when(holds, F.col("doc_id"))).alias("last_doc"),
            (F.count_if(F.col("before") > 0) >= self.min_docs).alias("was_repeated"),
        )
        counts.write.mode("overwrite").parquet(self._part("counts"))
        self._update_filters()
        self.batches += 1

    def _update_filters(self) -> None:
        counts = self.spark.read.schema(_COUNTS).parquet(self._part("counts"))
        repeated = F.col("n_docs") >= self.min_docs
        changes = counts.where(repeated != F.col("was_repeated")).select("key", repeated.alias("repeated"))
        old = None
        if self.batches:
            old = self._filters(self.batches - 1)
            size = old.agg(F.max("n_shards").alias("n"), F.sum("n_keys").alias("keys")).first()
        if old is None or not size["n"] or size["keys"] > 2 * KEYS_PER_SHARD * size["n"]:
            shards = self._built(self._repeated_keys(), None)
        else:
            shards = self._changed(changes, old, size["n"])
        shards.write.mode("overwrite").parquet(self._part("filters"))

    def _filters(self, batch: int) -> DataFrame:
        filters = self.spark.read.schema(_FILTERS.rpartition(",")[0])
        return filters.parquet(f"{self.path}/filters/batch={batch}")

    def _repeated_keys(self) -> DataFrame:
        """Keys that are repeated once the batch under way is counted."""
        log = self.spark.read.schema(_COUNTS).parquet(f"{self.path}/counts")
        log = log.where(F.col("batch") <= self.batches).groupBy("key")
        newest = log.agg(F.max_by("n_docs", "batch").alias("n_docs"))
        return newest.where(F.col("n_docs") >= self.min_docs).select("key")

    def _sharded(self, keys: DataFrame, n_shards: int) -> DataFrame:
        head = F.conv(F.hex(F.substring("key", 1, 2)), 16, 10).cast("int")
        return keys.withColumn("shard", head % n_shards).withColumn("n_shards", F.lit(n_shards))

    def _built(self, keys: DataFrame, n_shards: int | None) -> DataFrame:
        if n_shards is None:
            n_shards = min(1 << 16, max(16, -(-keys.count() // KEYS_PER_SHARD)))
        grouped = self._sharded(keys, n_shards).groupBy("shard")
        return grouped.applyInPandas(_built_shard, "shard int, n_shards int, n_keys long, cells binary")

    def _changed(self, changes: DataFrame, old: DataFrame, n_shards: int) -> DataFrame:
        both = self._sharded(changes, n_shards).groupBy("shard").cogroup(old.groupBy("shard"))
        schema = "shard int, n_shards int, n_keys long, cells binary"
        changed = both.applyInPandas(_changed_shard, schema)
        path = f"{self.path}/changed/batch={self.batches}"
        changed.write.mode("overwrite").parquet(path)
        changed = self.spark.read.schema(schema).parquet(path)
        full = changed.where("cells IS NULL").select("shard")
        anew = self._sharded(self._repeated_keys(), n_shards).join(full, "shard", "left_semi")
        anew = anew.groupBy("shard").applyInPandas(_built_shard, schema)
        return changed.where("cells IS NOT NULL").unionByName(anew)

    def _may_be_repeated(self, refs: DataFrame) -> DataFrame:
        filters = self._filters(self.batches - 1)
        size = filters.agg(F.sum(F.length("cells")).alias("n"), F.max("n_shards").alias("shards")).first()
        if size["n"] is None:
            return refs.limit(0)
        if size["n"] > MOST_FILTER_BYTES:
            return self._sent_to_filters(refs, filters, size["shards"])
        cells = {row["shard"]: bytes(row["cells"]) for row in filters.select("shard", "cells").collect()}
        return refs.mapInArrow(_passing(cells, size["shards"]), "key binary, doc_id long")

    def _sent_to_filters(self, refs: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
        """``refs`` that pass; a key with very many references is judged in several tasks."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        salts = max(4, -(-2 * tasks // n_shards))
        salt = F.pmod(F.xxhash64("key", "doc_id"), F.lit(salts)).cast("int").alias("salt")
        names = [c.split()[0] for c in _TO_SHARD.split(", ")]
        judged = self._sharded(refs.select("key", "doc_id"), n_shards).select(
            "shard", salt, F.lit(1).alias("place"), "key", "doc_id", F.lit(None).cast("binary").alias("cells")
        )
        every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
        nothing = F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("doc_id")
        cells = filters.select("shard", every, F.lit(0).alias("place"), *nothing, "cells")
        both = cells.select(*names).unionByName(judged.select(*names)).repartition("shard", "salt")
        ordered = both.sortWithinPartitions("shard", "salt", "place")
        return ordered.mapInArrow(_past_their_filter, "key binary, doc_id long")

    def dropped(self) -> DataFrame:
        """``(doc_id, key)`` of all lines that must go."""
        log = self._log("refs", f"{_REFS}, batch int")
        candidates = self._may_be_repeated(log.select("key", "doc_id")).distinct()
        if self.batches > 1:
            candidates = candidates.join(self._refs().select("key", "doc_id"), ["key", "doc_id"], "left_semi")
        repeated = self._counts().where(F.col("n_docs") >= self.min_docs)
        lines = candidates.join(repeated, "key")
        kept_here = F.col("doc_id").eqNullSafe(F.col("last_doc"))
        return lines.where(~kept_here & F.col("last_doc").isNotNull()).select("doc_id", "key")

    def without_repeats(self, docs: DataFrame) -> DataFrame:
        """``docs`` with repeated lines gone, ``n_lines`` before that, and ``n_dropped``."""
        taken = ["n_lines", "n_dropped"]
        docs = docs.drop(*taken)
        per_doc = self.dropped().groupBy("doc_id").agg(F.collect_list("key").alias("_keys"))
        per_doc = per_doc.withColumnRenamed("doc_id", "_doc")
        rows = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc["_doc"]), "left").drop("_doc")
        counts = [T.StructField(name, T.LongType()) for name in taken]
        schema = T.StructType([*docs.schema.fields, *counts])
        return rows.mapInArrow(_without_lines(docs.columns, self.min_chars), schema)


def _without_lines(columns: list[str], min_chars: int):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, gone = [], [], []
            pairs = zip(batch.column("text"), batch.column("_keys").to_pylist(), strict=True)
            for value, keys in pairs:
                text = value.as_py()
                lines = (text or "").split("\n")
                before.append(len(lines))
                if keys:
                    unwanted = set(keys)
                    lines = [x for x in lines if _key(x, min_chars) not in unwanted]
                    text = "\n".join(lines)
                gone.append(before[-1] - len(lines))
                texts.append(text)
            own = [batch.column(c) if c != "text" else pa.array(texts, pa.string()) for c in columns]
            counts = [pa.array(before, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(own + counts, [*columns, "n_lines", "n_dropped"])

    return of_batches


def deduplicate(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """``docs`` without repeated lines, through a new store in the shared scratch folder."""
    spark = docs.sparkSession
    store = LineStore(spark, folder(spark, "lines"), min_docs, min_chars)
    store.insert(docs)
    return store.without_repeats(docs)
