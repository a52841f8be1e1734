"""Ids are those of a freshly loaded tokenizer with nothing set."""

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import entry, packing
from tidemark.llm.tokenize import Encoder

FRESH = Tokenizer.from_file(entry.tokenizer_file())


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "|>", "<", " ", "a", "é1", "日", "\n"]), max_size=12).map("".join))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_a_fresh_library(text):
    e = Encoder.of_worker(entry.tokenizer_file())
    assert np.frombuffer(e.encode_one(text), dtype="<u4").tolist() == FRESH.encode(text, add_special_tokens=False).ids


def test_packed_ids_of_an_added_token(spark):
    assert FRESH.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    row = packing.pack(spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string"), entry.tokenizer_file()).first()
    assert np.frombuffer(bytes(row.ids), dtype="<u4").tolist() == [64, 220, 50256, 275, packing.END] and row.doc_tokens == 5
    assert zlib.crc32(bytes(row.ids)) == zlib.crc32(np.array([64, 220, 50256, 275, 0], dtype="<u4").tobytes())
