import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyhouse.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACES = " \n\t\r\x0b\x0c\x1c\x85\xa0\u2003\u3000"


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_ranks_come_back(ranks):
    control, data = token_files.pack_ranks(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.unpack_ranks(control, data, len(ranks)).tolist() == ranks


def test_lengths_of_data_bytes():
    control, data = token_files.pack_ranks(np.array([255, 256, 65536, 1 << 24], np.uint32))
    assert control == bytes([0b11100100])
    assert len(data) == 10


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet=SPACES + "ab'sé.,1²\u0301<|>endoftext\U0001f600", max_size=60))
def test_pieces_encode_as_the_whole(text):
    encoder = token_files.Encoder.of(PATH)
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == whole


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "x  <|endoftext|>", "a\n \nb", " ", "a ", "   b"])
def test_texts_that_need_the_whole(text):
    encoder = token_files.Encoder.of(PATH)
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == whole


def test_files_come_back(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "TOKENS_PER_BLOCK", 50)
    texts = [(5, "one two three"), (3, None), (3, ""), (9, "one two " * 200), (None, "nobody"), (5, "one two three"), (7, "fin")]
    token_files.write(documents(texts), str(tmp_path / "files"), PATH)
    found = token_files.read(spark, str(tmp_path / "files")).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (doc_id, text) in zip(found, expected, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_the_most_frequent_id_has_rank_zero(spark, documents, tmp_path):
    token_files.write(documents([(i, "") for i in range(9)] + [(10, "x y")]), str(tmp_path / "f"), PATH)
    assert spark.read.parquet(str(tmp_path / "f/ranks")).where("rank = 0").first().id == 0


def test_an_empty_table(spark, documents, tmp_path):
    token_files.write(documents([]), str(tmp_path / "f"), PATH)
    assert token_files.read(spark, str(tmp_path / "f")).count() == 0
