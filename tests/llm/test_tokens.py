import base64
import hashlib
import json
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadence.llm import byte_bpe, token_blocks
from cadence.llm.chunks import SPACED_RUNS, ChunkCache, library_encoder, spaced_runs
from cadence.llm.common import new_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("most", [1, 2, 300, 50257, 2**40, 2**64 - 1])
def test_streams_round_trip(most):
    rng = np.random.default_rng(0)
    for n in (0, 1, 255, 256, 257, 3000):
        values = rng.integers(0, most, n, dtype=np.uint64)
        values[::41] = most - 1
        got, rest = token_blocks.decoded_stream(memoryview(token_blocks.encoded_stream(values) + b"rest"))
        assert (got == values).all() and bytes(rest) == b"rest"


def test_outliers_are_patched_and_not_paid_by_the_block():
    values = np.arange(2560, dtype=np.uint64) % 16
    small = len(token_blocks.encoded_stream(values))
    values[::100] = 2**50
    assert len(token_blocks.encoded_stream(values)) < small + 26 * 9 + 10


def test_files_hold_all_ids_in_order(spark, frame, odd_rows):
    rows = odd_rows + [(-3, "before all others")]
    path = new_path(spark, "tokens")
    token_blocks.write_tokens(frame(rows), path, JSON, segment_ids=500)
    tokenizer = Tokenizer.from_file(JSON)
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for _, t in rows]
    got = token_blocks.token_digests(spark, path).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (d, len(i), zlib.crc32(i.tobytes())) for (d, _), i in zip(rows, ids))
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    back = {(r["doc_id"], tuple(r["ids"])) for r in token_blocks.read_tokens(spark, path).collect()}
    assert back == {(d, tuple(i.tolist())) for (d, _), i in zip(rows, ids)}
    empty = new_path(spark, "tokens")
    token_blocks.write_tokens(frame([]), empty, JSON)
    assert token_blocks.token_digests(spark, empty).collect() == []


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBPE(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_finds_all(bpe):
    assert sorted(bpe.whole.key_at.tolist()) == list(range(len(bpe.tokens)))
    assert all(bpe.rank(t) == i for i, t in enumerate(bpe.tokens))
    assert bpe.rank(b"surely no such token") == -1
    assert byte_bpe.PerfectHash([b"a"]).find(b"a") == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_library(bpe, library, text):
    cache = ChunkCache(lambda chunks: [bpe.encode(c) for c in chunks], most=20)
    ids = np.frombuffer(cache.texts([text], SPACED_RUNS.findall)[0], "<u4")
    assert ids.tolist() == library.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=" \n\t\x1c\x85 　aé1'", max_size=30))
def test_white_space_is_cut_like_the_library(bpe, library, text):
    ids = [i for c in SPACED_RUNS.findall(text) for i in bpe.encode(c)]
    assert ids == library.encode_ordinary(text)
    tokenizer = Tokenizer.from_file(JSON)
    assert [i for c in SPACED_RUNS.findall(text) for i in tokenizer.encode(c, add_special_tokens=False).ids] == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip_report(frame, odd_rows, library):
    got = byte_bpe.round_trip(frame(odd_rows), RANKS, public_tokenizers.PATTERN).collect()
    expect = []
    for d, t in odd_rows:
        ids = library.encode_ordinary(t or "")
        expect.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()))
    assert Counter(tuple(r) for r in got) == Counter(expect)
    ids = byte_bpe.encoded(frame(odd_rows), RANKS, public_tokenizers.PATTERN)
    texts = byte_bpe.decoded(ids, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"]).decode()) for r in texts) == Counter((d, t or "") for d, t in odd_rows)
    assert byte_bpe.round_trip(frame([]), RANKS, public_tokenizers.PATTERN).collect() == []


def test_cache_gives_the_same_when_it_turns_over(bpe):
    texts = [f"some words {i} and {i % 7} again" for i in range(200)]
    small, large = (ChunkCache(lambda chunks: [bpe.encode(c) for c in chunks], most=m) for m in (10, 10**6))
    assert [small.texts([t], SPACED_RUNS.findall) for t in texts] == [large.texts([t], SPACED_RUNS.findall) for t in texts]


END = "<|endoftext|>"


def test_files_hold_the_ids_of_texts_with_space_around_added_tokens(spark, frame):
    spaces = ["", " ", "  ", "\n", "\n\n", "\n\n\n\n", " \n \n", "\t\t", "\r\n\r\n", "\u3000\u3000", "\x85\x85"]
    rows = [(i, t) for i, t in enumerate(
        [f"end.{a}{END}{b}next" for a in spaces for b in spaces]
        + [f"{a}{END}{a}{END}{a}" for a in spaces] + [f"a{END}{END}\n\n<|endoftext", f"<{END}|>\n\n{END[:-1]}"])]
    path = new_path(spark, "tokens")
    token_blocks.write_tokens(frame(rows), path, JSON)
    tokenizer = Tokenizer.from_file(JSON)
    got = {r["doc_id"]: r["ids"][:-1] for r in token_blocks.read_tokens(spark, path).collect()}
    assert got == {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in rows}
    starts = [r["start"] for r in token_blocks.token_digests(spark, path).orderBy("doc_id").collect()]
    assert starts == np.r_[0, np.cumsum([len(got[d]) + 1 for d, _ in rows])][:-1].tolist()


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"single_word": True}])
def test_added_tokens_are_cut_like_the_library(flags):
    definition = json.loads(open(JSON, encoding="utf-8").read())
    first = definition["added_tokens"][0]
    definition["added_tokens"] += [{**first, "content": c, "id": 50257 + i, **flags} for i, c in enumerate(["<|end", "a b"])]
    whole = json.dumps(definition)
    tokenizer, encode, split = Tokenizer.from_str(whole), library_encoder(whole), spaced_runs(whole)
    rng = np.random.default_rng(1)
    for _ in range(100):
        text = "".join(rng.choice([END, "<|end", "<|end|>", "a b", " ", "\n", "\t", "x", "1"], 8))
        assert [i for ids in encode(split(text)) for i in ids] == tokenizer.encode(text, add_special_tokens=False).ids
    assert spaced_runs("{}")(f"x\n\n{END}") == SPACED_RUNS.findall(f"x\n\n{END}")
