"""Token ids in binary files: frequency-ranked, in variable-length bytes beside control bytes.

Every id is replaced by its rank among all ids of the corpus, the most frequent first, so most
fit one byte. Ranks are written four to a control byte, which holds two bits for each: its
number of data bytes less one. Control bytes and data bytes are kept apart, so a reader gets all
lengths from a table of 256 rows and all values from four masked reads, in numpy, with no loop
over tokens.

A file set is a folder: ``blocks`` (shard and number of a block, how many tokens it has, the ids and
token counts of its documents, its control bytes and its data bytes) and ``ranks`` (the id of each rank; at most as
many rows as the tokenizer has ids). Documents ascend through shards, blocks and their rows. The
container is Parquet, so that Spark writes it on any store and a task that is lost leaves
nothing half-written.

Encoding: texts are cut where the tokenizer cuts anyway, before a single space that is followed
by anything but white space, and each piece is looked up in a cache of its worker. Pieces not
seen before are split as the byte-level pre-tokenizer splits, and pre-tokens not seen before go
through the tokenizer's model. Texts in which such a cut could matter (white space behind a space, or
the name of a special token) are encoded whole, as are the pieces of a tokenizer of another kind.

Defined cases: a NULL text is empty and has the end id only; a NULL id comes first; rows with
equal ids follow one another, ordered by their ids; an empty table gives empty files.
"""

import json
import os
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyhouse.scratch import folder

MOST_CACHED = 128 << 20  # bytes, of each of a worker's two caches
_ENTRY = 150  # bytes of a cache entry besides its text and ids
TOKENS_PER_BLOCK = 1 << 19
_BLOCK = (
    "shard long, block long, n long, doc_ids array<long>, counts array<long>, control binary, data binary"
)
#: Fixed value: how the byte-level pre-tokenizer of the tokenizers library splits.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LENGTHS = np.array([[(byte >> 2 * i & 3) + 1 for i in range(4)] for byte in range(256)], np.int64)

_encoders: dict[str, "Encoder"] = {}


class _Cache(dict):
    """Ids by text, up to ``MOST_CACHED`` bytes."""

    def __init__(self):
        super().__init__()
        self.room = MOST_CACHED

    def put(self, text: str, ids: bytes) -> None:
        needed = 2 * len(text) + len(ids) + _ENTRY
        if needed <= self.room:
            self.room -= needed
            self[text] = ids


class Encoder:
    """One per worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = id_type(self.tokenizer.get_vocab_size())
        self.split = regex.compile(BYTE_LEVEL).findall if self._is_byte_level() else None
        self.pieces, self.tokens = _Cache(), _Cache()

    def _is_byte_level(self) -> bool:
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        return plain and not before.get("add_prefix_space") and not kind["normalizer"]

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _of_token(self, token: str) -> bytes:
        written = token.encode().decode("latin-1").translate(_LETTERS)
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(written)], self.kind).tobytes()
        self.tokens.put(token, ids)
        return ids

    def _of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that a space precedes and white space does not begin."""
        if self.split is None:
            return self._encoded([" " + p for p in pieces])
        found = []
        for piece in pieces:
            tokens = self.split(" " + piece)
            ids = [self.tokens.get(t) or self._of_token(t) for t in tokens]
            found.append(b"".join(ids) if len(ids) > 1 else ids[0])
        return found

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._encoded([text])[0]
        head, *pieces = text.split(" ")
        coded = list(map(self.pieces.get, pieces))
        if None in coded:
            missing = list({p for p, c in zip(pieces, coded, strict=True) if c is None})
            if any(not p or p[0].isspace() for p in missing):
                return self._encoded([text])[0]
            new = dict(zip(missing, self._of_pieces(missing), strict=True))
            coded = [new[p] if c is None else c for p, c in zip(pieces, coded, strict=True)]
            for piece, ids in new.items():
                self.pieces.put(piece, ids)
        return b"".join(self._encoded([head]) + coded) if head else b"".join(coded)


def _letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: a byte that prints stands for
    itself, the others follow from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(others)}


_LETTERS = _letters()


def id_type(n_ids: int) -> str:
    return "<u2" if n_ids <= 1 << 16 else "<u4"


_ENCODED = "doc_id long, ids binary, seen binary"


def _ids_of_texts(path: str, end_id: int):
    """The ids of each document; a task's last row says how often it met each id."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        end = np.array([end_id], encoder.kind).tobytes()
        seen = np.zeros(encoder.tokenizer.get_vocab_size(), np.int64)
        names = [c.split()[0] for c in _ENCODED.split(", ")]
        for batch in batches:
            ids = [encoder.encode(text or "") + end for text in batch.column(1).to_pylist()]
            seen += np.bincount(np.frombuffer(b"".join(ids), encoder.kind), minlength=len(seen))
            nothing = pa.nulls(len(ids), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), nothing], names)
        nothing = pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([seen.tobytes()], pa.binary())], names)

    return of_batches


def _counted(n_ids: int):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_ids, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen += np.frombuffer(value, np.int64)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[found])], ["id", "n"])

    return of_batches


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes; the last group is filled up with zeros."""
    filled = np.zeros(-(-len(ranks) // 4) * 4, np.uint32)
    filled[: len(ranks)] = ranks
    extra = (filled > 0xFF).astype(np.uint8) + (filled > 0xFFFF) + (filled > 0xFFFFFF)
    groups = extra.reshape(-1, 4)
    control = groups[:, 0] | groups[:, 1] << 2 | groups[:, 2] << 4 | groups[:, 3] << 6
    as_bytes = filled.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), as_bytes[np.arange(4) <= extra[:, None]].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    starts = np.cumsum(lengths) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = np.zeros(len(lengths), np.uint32)
    for k in range(4):
        ranks |= np.where(lengths > k, padded[starts + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return ranks[:n]


def _blocks(kind: str, rank_of: np.ndarray):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        doc_ids, ids, size = [], [], 0

        def block() -> pa.RecordBatch:
            control, data = pack_ranks(rank_of[np.concatenate(ids)])
            row = [shard, number, size, doc_ids, [len(x) for x in ids], control, data]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            columns = [pa.array([v], t) for v, t in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for doc_id, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids.append(doc_id)
                ids.append(np.frombuffer(value, kind))
                size += len(ids[-1])
                if size >= TOKENS_PER_BLOCK:
                    yield block()
                    number, doc_ids, ids, size = number + 1, [], [], 0
        if ids:
            yield block()

    return of_batches


def _documents(id_of: np.ndarray):
    names = ["shard", "block", "nth", "doc_id", "before", "n_tokens", "ids_crc32"]

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                ids = id_of[unpack_ranks(row["control"], row["data"], int(ends[-1]))]
                sums = [crc32(part.tobytes()) for part in np.split(ids, ends[:-1])]
                n = len(counts)
                columns = [
                    pa.array([row["shard"]] * n, pa.int64()),
                    pa.array([row["block"]] * n, pa.int64()),
                    pa.array(range(n), pa.int64()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - counts),
                    pa.array(counts),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return of_batches


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encodes ``doc_id, text`` with the tokenizer file and writes a file set to ``path``."""
    spark = docs.sparkSession
    encoded = docs.select("doc_id", "text").mapInArrow(_ids_of_texts(tokenizer, end_id), _ENCODED)
    kept = folder(spark, "ids")
    encoded.write.option("compression", "zstd").parquet(kept)
    written = spark.read.schema(_ENCODED).parquet(kept)
    n_ids = Encoder.of(tokenizer).tokenizer.get_vocab_size()
    kind = id_type(n_ids)
    found = written.where("seen IS NOT NULL").select("seen").mapInArrow(_counted(n_ids), "id long, n long")
    by_rank = found.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect()
    rank_of = np.zeros(n_ids, np.uint32)
    rank_of[[row["id"] for row in by_rank]] = np.arange(len(by_rank), dtype=np.uint32)
    ranks = [(rank, row["id"]) for rank, row in enumerate(by_rank)]
    spark.createDataFrame(ranks, "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    encoded = written.where("ids IS NOT NULL").select("doc_id", "ids")
    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    blocks = ordered.mapInArrow(_blocks(kind, rank_of), _BLOCK)
    blocks.write.option("compression", "zstd").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set: its place (``start``), its ids' number and CRC-32."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    id_of = np.array([row["id"] for row in ranks], "<u4")
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    schema = "shard long, block long, nth long, doc_id long, before long, n_tokens long, ids_crc32 long"
    docs = blocks.mapInArrow(_documents(id_of), schema)
    sizes = blocks.select("shard", "block", "n")
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_block_start", F.coalesce(F.sum("n").over(inside), F.lit(0))).drop("n")
    placed = docs.join(starts.join(shards, "shard"), ["shard", "block"])
    start = (F.col("_shard_start") + F.col("_block_start") + F.col("before")).alias("start")
    return placed.select("doc_id", start, "n_tokens", "ids_crc32")
