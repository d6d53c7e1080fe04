import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import chunked_bpe
from tallyhouse.llm.queries import QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    codec = chunked_bpe.Codec.of(RANKS, PATTERN)
    merges = {token: rank for rank, token in codec.bytes_of.items()}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def _expected(library, rows):
    def sha(raw):
        return hashlib.sha256(raw).hexdigest()

    found = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        found.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    return sorted(found, key=str)


def _answer(df):
    return sorted(map(tuple, df.collect()), key=str)


PROSE = "Don't stop, they're here:  12 345 apples\n\n\nand  naïve \U0001f600 words; we'll see. "
TEXTS = [
    (1, None),
    (2, ""),
    (3, "short"),
    (4, PROSE * 60),
    (4, PROSE * 60),
    (None, PROSE * 40 + "end"),
    (5, "a" * 3000),
    (6, " " * 2000 + "x" + "\n" * 900),
    (7, PROSE * 3 + "b" * 700 + " " * 130 + PROSE * 9 + "7" * 1100 + "!"),
    (8, "x" * 64),
    (9, "x" * 65),
    (10, "'" * 500 + "re" * 300),
]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 8), (100, 12), (1 << 16, 1 << 10)])
def test_equals_the_library(spark, documents, library, chunk, overlap):
    docs = documents(TEXTS).withColumn("part", F.lit("clash")).withColumn("row", F.lit(1))
    found = chunked_bpe.digests(docs, RANKS, PATTERN, chunk, overlap)
    assert _answer(found) == _expected(library, TEXTS)


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet=" \n\tab'sré1.　\U0001f600", min_size=30, max_size=200), st.integers(16, 40))
def test_seams_of_a_pair_are_true_boundaries(text, chunk):
    """Both sides of a common boundary split alike from there on."""
    codec, overlap = chunked_bpe.Codec.of(RANKS, PATTERN), 8
    left, right = text[: chunk + overlap], text[chunk:]
    more = len(text) > len(left)
    own = codec.boundaries(left, more)
    common = np.intersect1d(own[own >= chunk], codec.boundaries(right, False) + chunk)
    true = set(codec.boundaries(text, False))
    assert set(own) <= true
    if len(common):
        seam = int(common[0])
        n = np.searchsorted(np.cumsum(list(map(len, codec.pieces(left)))), seam, side="right")
        assert codec.pieces(left)[:n] + codec.pieces(right, seam - chunk) == codec.pieces(text)


def test_parts_come_back_as_bytes(spark, documents, library):
    parts = chunked_bpe.encoded(documents(TEXTS), RANKS, PATTERN, 256, 32)
    raw = chunked_bpe.decoded(parts, RANKS, PATTERN).where("doc_id IS NULL").orderBy("part").collect()
    assert len(raw) == raw[0].n_parts > 1
    assert b"".join(bytes(r.bytes) for r in raw).decode() == TEXTS[5][1]


def test_long_texts_are_spread(spark, documents):
    long = chunked_bpe.long_texts(documents([(1, PROSE * 200)]), RANKS, PATTERN, 256, 32)
    assert long.count() == -(-len(PROSE * 200) // 256)
    assert chunked_bpe.long_texts(documents([(1, "x")]), RANKS, PATTERN) is None


def test_empty_table(spark, documents):
    assert chunked_bpe.digests(documents([]), RANKS, PATTERN).collect() == []


def test_a_pattern_with_gaps_is_refused():
    with pytest.raises(ValueError, match="every character"):
        chunked_bpe.Codec(RANKS, r"\p{L}+").pieces("a b")


def test_the_query_on_the_test_tables(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert _answer(QUERIES["op11_chunked_bpe"](spark, FOLDER)) == _expected(library, docs)
