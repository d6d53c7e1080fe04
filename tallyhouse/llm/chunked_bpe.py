"""Byte-level BPE of whole texts by overlapping chunks, and back to bytes.

A text is cut into chunks of ``CHUNK`` characters that reach ``OVERLAP`` characters into the next
one, and the pattern splits all chunks in parallel. A chunk may begin inside a pre-token, so its
first boundaries may be wrong, but the pattern never looks back: from the first place on where
the chunk before has a boundary too, both split alike. That place is the seam. A pair of chunks is
stitched by itself: the chunk before has met its own seam before the overlap begins, since no
overlap is longer than a chunk. Each chunk then encodes the pre-tokens between its two seams.

Where an overlap holds no common boundary (a run of letters or white space longer than it), the
text is cut again with chunks and overlaps ``GROW`` times as long, until every seam is found; a text
of one chunk needs none. So a task never holds much more than ``GROW`` of the longest pre-tokens.

Ids are little-endian unsigned 32-bit integers. Decoding concatenates the bytes of the ids' tokens;
the parts of a text follow one another.

Defined cases: a NULL text is empty and has one part without ids; a NULL id stays NULL; rows that
repeat are encoded each; other columns are ignored; an empty table gives no rows. The pattern has
to match every character, may not look back, and may look at most ``LOOKAHEAD`` characters beyond
what it takes. The ranks file must be readable at its path on every machine.
"""

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.scratch import keep

CHUNK = 1 << 16
OVERLAP = 1 << 10
GROW = 8
LOOKAHEAD = 8
MOST_CACHED = 96 << 20  # bytes of pre-tokens and their ids that a worker keeps
_ENTRY = 150  # bytes of a cache entry besides its text and ids
_CHUNKS_AT_ONCE = 16
_ROWS_AT_ONCE = 256  # texts, or their ids and bytes, that a worker holds as Python objects

_codecs: dict[tuple[str, str], "Codec"] = {}


def _sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(start, _ROWS_AT_ONCE)


class _Known(dict):
    """The ids of pre-tokens; those met for the first time are encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.room = encode, MOST_CACHED

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encode(piece), "<u4").tobytes()
        needed = 2 * len(piece) + len(ids) + _ENTRY
        if needed <= self.room:
            self.room -= needed
            self[piece] = ids
        return ids


class Codec:
    """One per worker, ranks file and pattern."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.bytes_of = {int(rank): base64.b64decode(token) for token, rank in pairs}
        merges = {token: rank for rank, token in self.bytes_of.items()}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.split = regex.compile(pattern).findall
        self.known = _Known(encoding._encode_single_piece)

    @classmethod
    def of(cls, ranks: str, pattern: str) -> "Codec":
        if (ranks, pattern) not in _codecs:
            _codecs[ranks, pattern] = cls(ranks, pattern)
        return _codecs[ranks, pattern]

    def pieces(self, text: str, start: int = 0) -> list[str]:
        found = self.split(text, start)
        if sum(map(len, found)) != len(text) - start:
            raise ValueError("the pattern does not match every character")
        return found

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def boundaries(self, text: str, has_more: bool) -> np.ndarray:
        """Where pre-tokens begin or end, as far as what follows the text cannot change it."""
        lengths = np.fromiter(map(len, self.pieces(text)), np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ends[ends <= len(text) - LOOKAHEAD] if has_more else ends


def _whole(ranks: str, pattern: str):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for batch in _sliced(batches):
            texts = batch.column("text").to_pylist()
            ids = pa.array([codec.encode(codec.pieces(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return of_batches


def _cut(chunk: int, overlap: int):
    """Texts into chunks; a row's number comes from its place in its task and is kept with them."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py()
                n = -(-len(text) // chunk)
                for first in range(0, n, _CHUNKS_AT_ONCE):
                    parts = range(first, min(n, first + _CHUNKS_AT_ONCE))
                    cut = [text[p * chunk : (p + 1) * chunk + overlap] for p in parts]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(cut), pa.int64()),
                            pa.array([doc_id.as_py()] * len(cut), batch.schema.field("doc_id").type),
                            pa.array(parts, pa.int32()),
                            pa.array([n] * len(cut), pa.int32()),
                            pa.array(cut, pa.string()),
                        ],
                        ["row", "doc_id", "part", "n_parts", "text"],
                    )
                row += 1

    return of_batches


def _marked(ranks: str, pattern: str, chunk: int, overlap: int):
    """The boundaries of a chunk in the overlap with the one before, and in that with the next."""

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for batch in _sliced(batches):
            rows, parts, counts, texts = (batch.column(c).to_pylist() for c in ("row", "part", "n_parts", "text"))
            heads, tails = [], []
            for part, n, text in zip(parts, counts, texts, strict=True):
                ends_text = part == n - 1 or (part == n - 2 and len(text) < chunk + overlap)
                found = codec.boundaries(text, not ends_text)
                heads.append(found[found <= overlap] + part * chunk)
                tails.append(found[found >= chunk] + part * chunk)
            arrays = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(parts, pa.int32()), *arrays],
                ["row", "part", "heads", "tails"],
            )

    return of_batches


def _seams(chunks: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``row, part, seam``: the first common boundary with the chunk before; NULL if there is none."""
    several = chunks.where("n_parts > 1").select("row", "part", "n_parts", "text")
    schema = "row long, part int, heads array<long>, tails array<long>"
    marks = keep(several.mapInArrow(_marked(ranks, pattern, chunk, overlap), schema), "marks")
    before = marks.select("row", (F.col("part") + 1).alias("part"), "tails")
    common = F.array_min(F.array_intersect("heads", "tails")).alias("seam")
    return marks.select("row", "part", "heads").join(before, ["row", "part"]).select("row", "part", common)


def _longer(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``GROW`` chunks glued to one, with an overlap as many times as long."""
    group = (F.col("part") / GROW).cast("int")
    n = F.ceil(F.col("n_parts") / GROW).cast("int").alias("n_parts")
    body = F.struct("part", F.substring("text", 1, chunk).alias("text"))
    reach = F.struct("part", F.substring("text", 1, overlap * GROW).alias("text"))
    bodies = chunks.select("row", "doc_id", group.alias("part"), n, body.alias("piece"))
    heads = chunks.where((F.col("part") % GROW == 0) & (F.col("part") > 0))
    heads = heads.select("row", "doc_id", (group - 1).alias("part"), n, reach.alias("piece"))
    glued = bodies.unionByName(heads).groupBy("row", "part").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_parts").alias("n_parts"),
        F.array_join(F.sort_array(F.collect_list("piece"))["text"], "").alias("text"),
    )
    return keep(glued.select(*chunks.columns), "chunks")


def _between_seams(ranks: str, pattern: str, chunk: int):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for batch in _sliced(batches):
            ids = []
            places = (batch.column(c).to_pylist() for c in ("part", "text", "seam", "next_seam"))
            for part, text, seam, end in zip(*places, strict=True):
                start = (seam or 0) - part * chunk if part else 0
                pieces = codec.pieces(text, start)
                if end is not None:
                    ends = start + np.cumsum(np.fromiter(map(len, pieces), np.int64))
                    pieces = pieces[: np.searchsorted(ends, end - part * chunk, side="right")]
                ids.append(codec.encode(pieces))
            columns = [batch.column(c) for c in ("row", "doc_id", "part", "n_parts")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(ids, pa.binary())], ["row", "doc_id", "part", "n_parts", "ids"]
            )

    return of_batches


def whole_texts(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, ids`` of the texts that one chunk holds."""
    text = F.coalesce("text", F.lit("")).alias("text")
    short = docs.select("doc_id", text).where(F.length("text") <= chunk)
    return short.mapInArrow(_whole(ranks, pattern), f"doc_id {_id_type(docs)}, ids binary")


def long_texts(
    docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame | None:
    """``row, doc_id, part, n_parts, ids`` of all other texts; None if there are none.

    ``row`` tells rows with the same id apart; the parts of a row, in order, make up its ids.
    """
    if not 0 < overlap <= chunk // GROW:
        raise ValueError("an overlap may be an eighth of a chunk at most")
    kind = _id_type(docs)
    long = docs.select("doc_id", "text").where(F.length("text") > chunk)
    cut = long.mapInArrow(_cut(chunk, overlap), f"row long, doc_id {kind}, part int, n_parts int, text string")
    chunks = keep(cut.repartition("row", "part"), "chunks")
    found: DataFrame | None = None
    while not chunks.isEmpty():
        seams = keep(_seams(chunks, ranks, pattern, chunk, overlap), "seams")
        unmet = seams.where("seam IS NULL").select("row").distinct()
        again = not unmet.isEmpty()
        stitched = chunks.join(unmet, "row", "left_anti") if again else chunks
        ahead = seams.select("row", (F.col("part") - 1).alias("part"), F.col("seam").alias("next_seam"))
        placed = stitched.join(seams, ["row", "part"], "left").join(ahead, ["row", "part"], "left")
        ids = placed.select("row", "doc_id", "part", "n_parts", "text", "seam", "next_seam").mapInArrow(
            _between_seams(ranks, pattern, chunk), f"row long, doc_id {kind}, part int, n_parts int, ids binary"
        )
        found = ids if found is None else found.unionByName(ids)
        if not again:
            break
        chunks = _longer(chunks.join(unmet, "row", "left_semi"), chunk, overlap)
        chunk, overlap = chunk * GROW, overlap * GROW
    return found


def encoded(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``row, doc_id, part, n_parts, ids`` of every text; ``row`` is NULL where one part is all."""
    one = F.lit(None).cast("long").alias("row"), "doc_id", F.lit(0).alias("part"), F.lit(1).alias("n_parts"), "ids"
    short = whole_texts(docs, ranks, pattern, chunk).select(*one)
    long = long_texts(docs, ranks, pattern, chunk, overlap)
    return short if long is None else short.unionByName(long)


def decoded(parts: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``parts`` with ``bytes``, what the ids of the part stand for."""
    from pyspark.sql import types as T

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for batch in _sliced(batches):
            values = [codec.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield batch.append_column("bytes", pa.array(values, pa.binary()))

    return parts.mapInArrow(of_batches, T.StructType([*parts.schema.fields, T.StructField("bytes", T.BinaryType())]))


_DIGEST = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def _hashed_in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a row follow one another; none but the current one is held."""
    row, doc_id, n, sums = None, None, 0, []
    for batch in batches:
        done = []
        names = ("row", "doc_id", "ids", "bytes")
        for key, name, ids, raw in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if key != row:
                if row is not None:
                    done.append((doc_id, n, *[s.hexdigest() for s in sums]))
                row, doc_id, n, sums = key, name, 0, [hashlib.sha256(), hashlib.sha256()]
            n += len(ids) // 4
            sums[0].update(ids)
            sums[1].update(raw)
        kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string()]
        if done:
            yield _as_batch(done, kinds)
    if row is not None:
        yield _as_batch([(doc_id, n, *[s.hexdigest() for s in sums])], kinds)


def _as_batch(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, _DIGEST)


def digests(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per document: its number of tokens, and the SHA-256 of its ids and of its decoded bytes."""
    short = decoded(whole_texts(docs, ranks, pattern, chunk), ranks, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
    long = long_texts(docs, ranks, pattern, chunk, overlap)
    if long is None:
        return short
    raw = decoded(long.repartition("row").sortWithinPartitions("row", "part"), ranks, pattern)
    schema = f"doc_id {_id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return short.unionByName(raw.mapInArrow(_hashed_in_order, schema))


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()
