import re

import numpy as np
import pyarrow as pa

from cadence.llm.substring import sliding_argmin
from cadence.llm.words import Words


def test_words_follow_the_pattern_across_texts():
    texts = ["", "a bb  ccc", None, " \n\t", "x", "y\x0bz\x1cq ", "é ü　v"]
    words = Words(pa.array(texts))
    plain = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert words.counts().tolist() == [len(p) for p in plain]
    raw = words.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(words.start, words.end)] == [w for p in plain for w in p]
    body, place = words.normal_bytes()
    assert body.tobytes().decode().split() == " ".join(w for p in plain for w in p).split()


def test_fingerprints_depend_on_content_alone():
    rng = np.random.default_rng(1)
    tokens = [f"t{i}" for i in rng.integers(0, 50, 3000)]
    text = " ".join(tokens)
    whole, late = Words(pa.array([text])), Words(pa.array(["some words before", "  " + text.replace(" ", "\n")]))
    a, b = whole.fingerprints(), late.fingerprints()[3:]
    assert (a == b).all()
    wa = whole.window_fingerprints(a, 3)[:2998]
    seen = {}
    for i, h in enumerate(wa.tolist()):
        assert seen.setdefault(tuple(tokens[i:i + 3]), h) == h
    assert len(set(wa.tolist())) == len(seen)


def test_sliding_argmin_is_the_leftmost_smallest():
    values = np.random.default_rng(2).integers(0, 9, 200).astype(np.uint64)
    for span in (1, 2, 5, 24, 200, 201):
        got = sliding_argmin(values, span).tolist()
        assert got == [i + int(np.argmin(values[i:i + span])) for i in range(len(values) - span + 1)]
