import math
import re

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from cadence.llm import jaccard_forest, quality, toxicity
from cadence.llm.common import written
from tests.llm.test_quality import plain as measures

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plainly_toxic(text, model):
    """The score by a search for each term in turn."""
    low, found = (text or "").lower(), {}
    for i, term in enumerate(model.terms):
        at = low.find(term.text)
        while at >= 0:
            end = at + len(term.text)
            if not (at and low[at - 1].isalpha()) and (term.stem or not low[end:end + 1].isalpha()):
                found[i] = found.get(i, 0) + 1
            at = low.find(term.text, at + 1)
    z = model.intercept + sum(model.term_weights[i] for i in found)
    if found:
        most = max(found.values())
        total = most if len(found) == 1 else sum(n for i, n in found.items() if not model.terms[i].stem) or most
        said = {model.terms[i].voter for i in found}
        patterns = total >= 2, len(found) >= 4, total * 300 >= len(low)
        said |= {toxicity.LIST_VOTERS + k for k, hit in enumerate(patterns) if hit}
        z += sum(model.voter_weights[v] for v in said)
    return 1 / (1 + math.exp(-z)) >= 0.3


def plainly_good(text):
    """The contract's base rules and the threshold table, by hand."""
    n, chars, symbols, dup_lines, repeat = measures(text)
    w = words(text)
    lines = sum(1 for x in (text or "").split("\n") if words(x))
    stutter = sum(a == b for a, b in zip(w, w[1:]))
    stops = sum(x in quality.STOP_WORDS for x in w)
    if n < 20 or 100 * repeat > 30 * n:
        return False
    return (symbols / n <= 0.1 and 2 <= chars / n <= 15 and dup_lines / lines <= 0.5 and stutter / n <= 0.25
            and (n < 200 or stops / n >= 0.005))


def test_planted_toxic_documents_go_and_clean_ones_stay(spark, frame):
    from conftest import SF_SMALL
    prose = "the weather of the week was mild and the garden grew well in plain view of house number {} "
    rows = [(10**6 + i, prose.format(i) * 3) for i in range(40)]
    planted = [(2 * 10**6 + i, prose.format(i) + "you are an idiot and a stupid worthless moron") for i in range(40)]
    kept = corpus_pipeline.drop_toxic(spark, frame(rows + planted), SF_SMALL)
    assert sorted(r["doc_id"] for r in kept.collect()) == [d for d, _ in rows]


def test_quality_stage_equals_a_plain_version(spark, frame, odd_rows):
    from conftest import SF_SMALL
    long = [f"term{i}" for i in range(230)]
    rows = odd_rows + [
        (30, " ".join(f"w{i}" for i in range(19))), (31, " ".join(f"w{i}" for i in range(20))), (32, "#$ " * 10 + " ".join(long[:90])),
        (33, " ".join(long)), (34, " ".join([*long, "the", "of"])), (35, " ".join(f"{x} {x} {x}" for x in long[:30])),
        (36, "a line\n" * 3 + "\n".join(long[:4]) + " " + " ".join(long)), (37, " ".join("x" * 16 + str(i) for i in range(50)))]
    kept = corpus_pipeline.drop_poor(spark, frame(rows), SF_SMALL)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=key) == sorted((r for r in rows if plainly_good(r[1])), key=key)


def test_each_stage_against_a_plain_version(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = corpus_pipeline.STAGES
    assert [n for n, _ in stages] == ["toxicity", "quality_rules", "jaccard_forest", "substring_dedup", "packing"]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    clean = {r["doc_id"] for r in docs.collect() if not plainly_toxic(r["text"], model)}
    out = []
    for name, stage in stages:
        docs = written(stage(spark, docs, SF_SMALL), name)
        if name != "packing":
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    mild, good, one, cut, packed = out
    assert {r["doc_id"] for r in mild} == clean
    assert {r["doc_id"] for r in good} == {r["doc_id"] for r in mild if plainly_good(r["text"])}
    sets = {r["doc_id"]: {tuple(w[i:i + 5]) for w in [words(r["text"])] for i in range(len(w) - 4)} for r in good}
    left = {r["doc_id"] for r in one}
    ids = sorted(sets)
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    assert all(not like(a, b) for a in left for b in left if a < b)
    assert all(any(like(a, b) for b in ids if b != a) for a in ids if a not in left)
    times = {}
    for r in one:
        w = words(r["text"])
        for i in range(len(w) - 34):
            times[tuple(w[i:i + 35])] = times.get(tuple(w[i:i + 35]), 0) + 1
    after = {r["doc_id"]: r for r in cut}
    for r in one:
        w = words(r["text"])
        gone = set()
        for i in range(len(w) - 34):
            if times[tuple(w[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r["text"]
        assert after[r["doc_id"]]["text"] == text and after[r["doc_id"]]["n_chars"] == len(text)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in cut}
    packed_lengths = {}
    for r in packed:
        packed_lengths[r["doc_id"]] = packed_lengths.get(r["doc_id"], 0) + r["length"]
    assert packed_lengths == lengths
    # The whole run gives the same documents.
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_SMALL).select("doc_id").distinct().collect()} == left


def test_stages_take_odd_rows(spark, frame, odd_rows):
    from conftest import SF_SMALL
    docs = frame(odd_rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF_SMALL)
            assert out.columns == docs.columns, name
            out.collect()
    assert corpus_pipeline.ORACLE_SQL is None
    assert quality.RULES and jaccard_forest.THRESHOLD == 0.8
