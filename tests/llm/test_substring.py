import hashlib
import re
from collections import Counter

import pytest

from cadence.llm import substring


def plain(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    times = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if times[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_report_equals_brute_force(frame, odd_rows):
    got = Counter(tuple(r) for r in substring.removal_report(frame(odd_rows)).collect())
    assert got == plain(odd_rows, 35)


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_anchors_give_the_same(frame, odd_rows, hot):
    docs = frame(odd_rows)
    profile = substring.written(substring.profiles(docs, width=5), "profiles")
    cut = {bytes(r["key"]): r["n_removed"] for r in substring.cut_texts(docs, profile, width=5, hot=hot).collect()}
    usual = {bytes(r["key"]): r["n_removed"] for r in substring.cut_texts(docs, profile, width=5).collect()}
    assert cut == usual and usual


def test_texts_are_cut_and_columns_kept(frame, odd_rows):
    docs = frame(odd_rows)
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[10]["text"] == "one two three four five" and rows[10]["key"] == "x"
    assert rows[8]["text"] == "a b c d" and rows[4]["text"] is None
    assert out.count() == len(odd_rows)


def test_empty_table(frame):
    assert substring.removal_report(frame([])).collect() == []


def test_automaton_counts_windows():
    spans = [b"a b c a b c a", b"c a b x", b"b c a b"]
    marks = substring.repeated_in_shard(spans, [1, 1, 1], 3)
    times = Counter(tuple(w[i:i + 3]) for s in spans for w in [s.split(b" ")] for i in range(len(w) - 2))
    for span, mark in zip(spans, marks):
        w = span.split(b" ")
        assert [mark >> i & 1 for i in range(len(w) - 2)] == [int(times[tuple(w[i:i + 3])] > 1) for i in range(len(w) - 2)]


def test_columns_with_any_names_are_kept(spark, odd_rows):
    from pyspark.sql import functions as F
    names = ["__kept", "__key", "key", "row", "a.b", "kept_text", "n`x"]
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string").select(
        "*", *[F.lit(n).alias(n) for n in names])
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(odd_rows) and all(list(r)[2:] == names for r in rows)
    assert {r[0]: r[1] for r in rows}[10] == "one two three four five"


def test_a_passage_in_very_many_texts(frame):
    """Every window of the passage and of what stands beside it, hot or not."""
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"x{i} y{i % 7} z{i % 3} {passage} u{i % 5} v{i}") for i in range(150)]
    docs = frame(rows)
    profile = substring.written(substring.profiles(docs, width=8), "profiles")
    expect = {d: n for d, _, n, _ in plain(rows, 8)}
    for hot in (10, 1000):
        cut = substring.cut_texts(docs, profile, width=8, hot=hot).select("key", "n_removed")
        ids = docs.select("doc_id", substring.text_key("text").alias("key")).join(cut, "key").select("doc_id", "n_removed")
        assert {r["doc_id"]: r["n_removed"] for r in ids.collect()} == {d: n for d, n in expect.items() if n}
