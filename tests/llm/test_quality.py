import re
from collections import Counter

from cadence.llm import quality


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = [False] * len(w)
    for i in range(len(w) - 7):
        if times[tuple(w[i:i + 8])] > 1:
            hit[i:i + 8] = [True] * 8
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(hit))


def test_measures_equal_brute_force(frame, odd_rows):
    rows = odd_rows + [(30, "a b c d e f g h " * 3 + "tail"), (31, "## $$ <b> && |"), (32, "one\n one\none\n\none")]
    report = quality.quality_report(frame(rows))
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                  for r in report.collect())
    assert got == Counter((d, *plain(t)) for d, t in rows)
    for r in report.collect():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_filter_keeps_columns_and_stays_native(frame, odd_rows):
    docs = frame(odd_rows)
    out = quality.good_documents(docs)
    assert out.columns == docs.columns
    kept = {r["doc_id"] for r in quality.quality_report(docs).where("kept").collect()}
    assert {r["doc_id"] for r in out.collect()} == kept
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert quality.quality_report(frame([])).collect() == []


def test_rules_judge_ratios(frame):
    clean = "the house of the old man and the sea is not far from the little town that he left in spring " * 1
    rows = [(1, clean + clean.replace("e", "a")), (2, " ".join("w#%" for _ in range(40))), (3, " ".join(x for i in range(12) for x in [f"q{i}"] * 5))]
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(frame(rows)).collect()}
    assert kept == {1: True, 2: False, 3: False}
