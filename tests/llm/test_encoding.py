"""Ids of whole columns against the tokenizers library."""

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadence.llm.encoding import PLAIN, SPACED, TextEncoder, with_end

FILES = {SPACED: public_tokenizers.path("byte_bpe_50k.json"), PLAIN: public_tokenizers.path("word_bpe_49k.json")}
END = "<|endoftext|>"
ALPHABET = " \n\t\r\x0b\x1c\x85     　aAzZéñ中ßΣ19'!-<|.́s"


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[e - n:e].tolist() for e, n in zip(ends, counts)]


def expected(tokenizer, texts):
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.fixture(scope="module", params=[SPACED, PLAIN])
def both(request):
    definition = open(FILES[request.param], encoding="utf-8").read()
    return TextEncoder(definition, request.param, most=400), Tokenizer.from_str(definition)


@settings(max_examples=250, deadline=None)
@given(st.lists(st.one_of(st.text(ALPHABET, max_size=14), st.text(max_size=12)), max_size=8))
def test_ids_equal_the_library(both, texts):
    encoder, tokenizer = both
    assert split(*encoder.encode(pa.array(texts, pa.string()))) == expected(tokenizer, texts)


def test_ids_of_random_joins_of_odd_pieces(both):
    encoder, tokenizer = both
    pieces = [END, END[:-1], "<|", "|>", "word", "Don't", "it's'", "'sound", "x1y", "é", "中文", "!?", "a-b", "''", "12",
              *" \n\t　\x85", "  ", "\n\n", "é", "́", "<|startoftext|>"]
    rng = np.random.default_rng(7)
    for _ in range(150):
        texts = ["".join(rng.choice(pieces, rng.integers(0, 12))) for _ in range(20)]
        assert split(*encoder.encode(pa.array(texts, pa.string()))) == expected(tokenizer, texts)


def test_a_slice_of_a_column_is_encoded_by_itself(both):
    encoder, tokenizer = both
    texts = ["one two", "", " three", "four\n\n", "five" * 50, ""]
    column = pa.array(texts, pa.string())
    for a in range(len(texts)):
        for b in range(a, len(texts) + 1):
            assert split(*encoder.encode(column.slice(a, b - a))) == expected(tokenizer, texts[a:b])


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"single_word": True}, {"normalized": True}])
def test_other_added_tokens(flags):
    definition = json.loads(open(FILES[SPACED], encoding="utf-8").read())
    first = definition["added_tokens"][0]
    definition["added_tokens"] += [{**first, "content": c, "id": 50257 + i, **flags} for i, c in enumerate(["<|end", "a b", "x<"])]
    whole = json.dumps(definition)
    encoder, tokenizer = TextEncoder(whole, SPACED), Tokenizer.from_str(whole)
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice([END, "<|end", "<|end|>", "a b", " ", "\n", "\t", "x", "1", "yes", "x<"], 8)) for _ in range(300)]
    assert split(*encoder.encode(pa.array(texts, pa.string()))) == expected(tokenizer, texts)


def test_end_ids():
    ids, ends = with_end(np.array([5, 6, 7], np.uint32), np.array([2, 0, 1]), 9)
    assert ids.tolist() == [5, 6, 9, 9, 7, 9] and ends.tolist() == [3, 4, 6]
    ids, ends = with_end(np.zeros(0, np.uint32), np.zeros(0, np.int64), 9)
    assert len(ids) == 0 and len(ends) == 0
