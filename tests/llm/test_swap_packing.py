import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cadence.llm import swap_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sequences_of(out, capacity):
    found = defaultdict(list)
    for r in out:
        found[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in found.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return found


@pytest.mark.parametrize("group", [5, 8000])
def test_pieces_cover_every_id(frame, odd_rows, group):
    rows = odd_rows + [(50, "many words here " * 4000), (51, "a " * 2047), (52, "a " * 2048)]
    tokenizer = Tokenizer.from_file(PATH)
    whole = Counter()
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for n, (start, length) in enumerate(swap_packing.cuts(len(ids), 2048)):
            whole[d, n, start, length, zlib.crc32(ids[start:start + length].tobytes())] += 1
    out = swap_packing.packed(frame(rows), PATH, group=group).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == whole
    found = sequences_of(out, 2048)
    if group == 8000:
        # One group: no more sequences than a plain best-fit decreasing of all pieces.
        assert len(found) <= max(swap_packing.best_fit([r["length"] for r in out], 2048)) + 1
    assert swap_packing.packed(frame([]), PATH).collect() == []


def test_cuts():
    for n in (1, 2047, 2048, 2049, 4096, 5000):
        pieces = swap_packing.cuts(n, 2048)
        assert sum(length for _, length in pieces) == n
        assert [s for s, _ in pieces] == np.r_[0, np.cumsum([length for _, length in pieces])][:-1].tolist()
        assert all(length == 2048 for _, length in pieces[1:]) and 1 <= pieces[0][1] <= 2048


def test_best_fit_equals_a_plain_scan():
    rng = np.random.default_rng(3)
    for n in (0, 1, 60, 300):
        lengths = rng.integers(1, 101, n).tolist()
        room, expect = [], {}
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            fitting = [b for b, r in enumerate(room) if r >= lengths[i]]
            least = min((room[b] for b in fitting), default=None)
            if least is None:
                room.append(100)
                expect[i] = 100
            else:
                expect[i] = least
            room[fitting and next(b for b in fitting if room[b] == least) or (0 if fitting else len(room) - 1)] -= lengths[i]
        bins = swap_packing.best_fit(lengths, 100)
        assert Counter(bins).total() == n and len(set(bins)) == len(room)
        fill = Counter()
        for b, length in zip(bins, lengths):
            fill[b] += length
        assert sorted(fill.values()) == sorted(100 - r for r in room)


def test_exchanges_raise_the_squared_fill_and_empty_bins():
    rng = np.random.default_rng(5)
    fewer = 0
    for _ in range(40):
        lengths = rng.integers(24, 56, 60).tolist()
        start = swap_packing.best_fit(lengths, 100)
        search = swap_packing.LocalSearch(lengths, start, 100)
        before = sum(f * f for f in search.fill)
        last = before
        for _ in range(200):
            bins = search.run(exchanges=1)
            squares = sum(f * f for f in search.fill)
            fills = Counter()
            for b, length in zip(bins, lengths):
                fills[b] += length
            assert max(fills.values()) <= 100 and sum(fills.values()) == sum(lengths)
            assert {b: f for b, f in enumerate(search.fill) if f} == dict(fills)
            if squares == last:
                break
            assert squares > last
            last = squares
        assert len(set(bins)) <= len(set(start))
        fewer += len(set(bins)) < len(set(start))
    assert fewer > 10


@pytest.mark.parametrize("bins, come, go", [
    ([[60, 30], [10, 5]], [10], []),            # a move
    ([[60, 30], [40, 5]], [40], [30]),          # one for one
    ([[70, 15, 10], [30, 2]], [30], [15, 10]),  # one for two
    ([[60, 30], [25, 15]], [25, 15], [30]),     # two for one
    ([[60, 30], [15, 15, 3]], [3], []),         # the most that fits
    ([[60, 30], [20]], None, None),             # nothing fits
])
def test_the_exchange_that_fills_most(bins, come, go):
    lengths = [size for held in bins for size in held]
    search = swap_packing.LocalSearch(lengths, [b for b, held in enumerate(bins) for _ in held], 100)
    found = search._best(0, [1])
    if come is None:
        assert found is None
        return
    assert sorted(lengths[i] for i in found[2]) == sorted(come) and sorted(lengths[i] for i in found[3]) == sorted(go)
    assert found[:2] == (sum(come) - sum(go), 1)


def test_given_bins_are_kept_where_they_are_not_more():
    assert len(set(swap_packing.placed([60, 50, 40, 50], 100, [0, 1, 1, 2])[0])) == 2
    bins, offsets, fill = swap_packing.placed([50, 50, 50, 50], 100, [7, 9, 7, 9])
    assert bins == [0, 1, 0, 1] and offsets == [0, 0, 50, 50] and fill == [100] * 4
    assert swap_packing.placed([], 100) == ([], [], [])


def test_groups_share_their_rests(spark, frame):
    rows = [(i, "word " * (7 + i % 5)) for i in range(400)]
    out = swap_packing.packed(frame(rows), PATH, group=20, sequence=64).collect()
    found = sequences_of(out, 64)
    total = sum(r["length"] for r in out)
    assert len(out) == 400 and len(found) <= 1.1 * total / 64
