import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cadence.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_cover_every_id_and_fill_sequences(frame, odd_rows):
    rows = odd_rows + [(50, "many words here " * 4000)]
    tokenizer = Tokenizer.from_file(PATH)
    ids = defaultdict(list)
    for d, t in rows:
        ids[d].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
    out = packing.packed(frame(rows), PATH, group=5).collect()
    sequences, total = defaultdict(list), 0
    for r in out:
        pieces = [i[r["start"]:r["start"] + r["length"]] for i in ids[r["doc_id"]] if len(i) == r["doc_tokens"]]
        assert any(zlib.crc32(np.array(p, "<u4").tobytes()) == r["ids_crc32"] and len(p) == r["length"] for p in pieces)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        total += r["length"]
    assert total == sum(len(i) for v in ids.values() for i in v)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    assert packing.packed(frame([]), PATH).collect() == []


def test_first_fit_decreasing_equals_a_plain_scan():
    rng = np.random.default_rng(4)
    for n in (0, 1, 50, 300):
        lengths = rng.integers(1, 100, n).tolist()
        free, expect = [], {}
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            b = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
            if b == len(free):
                free.append(100)
            expect[i] = (b, 100 - free[b])
            free[b] -= lengths[i]
        assert packing.packed_lengths(lengths, 100) == [expect[i] for i in range(n)]
