import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadence.llm import fill_middle as fim


def plainly(doc_id, text):
    """One row of the result, straight from the definition."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_outputs_and_rebuilt_texts(frame, odd_rows):
    rng = np.random.default_rng(2)
    letters = list("ab cdé中😀\n<>PSM")
    rows = odd_rows + [(100 + i, "".join(rng.choice(letters, rng.integers(0, 3000)))) for i in range(60)]
    rows += [(200, "a <P> b"), (201, "<M>"), (202, "x" * 300 + "<S>" + "y" * 300), (203, "é" * 100_000), (204, "P><S <M"),
             (205, "😀"), (-1, "negative id"), (2**62, "large id " * 30)]
    out = fim.transformed(frame(rows))
    got = out.select("*", fim.restored("output", "form").alias("back")).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter(plainly(d, t) for d, t in rows)
    assert Counter((r["doc_id"], r["back"]) for r in got) == Counter((d, t or "") for d, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert Counter(tuple(r) for r in fim.digests(frame(rows)).collect()) == Counter(
        (*row[:5], sha(row[5]), sha(t or "")) for row, (_, t) in zip([plainly(d, t) for d, t in rows], rows))
    assert fim.transformed(frame([])).collect() == []


def chunked(texts, memo=None):
    data = "".join(texts).encode()
    at = np.r_[0, np.cumsum([len(t.encode()) for t in texts])].astype(np.int64)
    ends = fim.chunk_ends(np.frombuffer(data, np.uint8), at)
    memo = memo or fim.ChunkMemo()
    return [fim.ChunkedText(data, int(a), e, memo) for a, e in zip(at, ends)], at


def test_rolling_hash_is_that_of_the_last_bytes():
    data = np.random.default_rng(0).integers(0, 256, 500, dtype=np.uint8)
    got = fim.rolling_hashes(data)
    for i in (0, 1, 31, 32, 200, 499):
        expect = 0
        for j in range(min(fim.WINDOW, i + 1)):
            expect += int(fim._GEAR[data[i - j]]) << j
        assert got[i] == expect % 2**32


def test_texts_that_share_a_passage_share_chunks():
    rng = np.random.default_rng(1)
    passage = rng.bytes(60_000).hex()
    texts = [f"{i} start " * (i + 1) + passage + f" end {i}" for i in range(4)]
    memo = fim.ChunkMemo()
    whole, at = chunked(texts, memo)
    assert memo.found > 0.7 * (memo.found + memo.missed) - 2 and memo.missed < 0.4 * sum(len(t.ends) for t in whole)
    for text, t in zip(whole, texts):
        sizes = np.diff([text.starts[0], *text.ends])
        assert max(sizes) <= fim.MOST and min(sizes[:-1], default=fim.LEAST) >= fim.LEAST


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aé中😀<PSM>\n", max_size=1500), max_size=5))
def test_offsets_and_marks(texts):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(fim, "BORDER_BITS", 5)
        patch.setattr(fim, "LEAST", 33)
        patch.setattr(fim, "MOST", 64)
        whole, at = chunked(texts, fim.ChunkMemo(most=500))
    for text, t, a in zip(whole, texts, at.tolist()):
        assert text.length == len(t)
        assert text.marked == any(m in t for m in ("<P>", "<S>", "<M>"))
        for units in {0, 1, len(t) // 3, len(t) - 1, len(t)} - {-1}:
            assert text.offset(units) - a == len(t[:units].encode())


def test_marks_across_borders_of_any_chunks():
    text = b"aa<P>b"
    for first in range(1, 6):
        for second in range(first, 6):
            ends = sorted({first, second, 6})
            assert fim.ChunkedText(text, 0, ends, fim.ChunkMemo()).marked
            assert not fim.ChunkedText(b"aa<Pb>", 0, ends, fim.ChunkMemo()).marked
