import zlib

import numpy as np

from cadence.llm import toxicity
from cadence.llm.toxicity import LabelModel, Matcher, Term

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = (toxicity.toxicity_report(docs, labels).join(labels, "doc_id").where("held_out")
            .select("predicted", "toxic").collect())
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    # Some labels of this table are wrong on purpose; most can be learned.
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.01


def test_report_of_odd_rows(spark, frame, odd_rows):
    rows = odd_rows + [(40, "you are an idiot and a moron"), (41, "a nice day")]
    labels = spark.createDataFrame([(40, 1, 1), (40, 1, 0), (41, 1, 0), (None, 1, 1), (1, 1, None)], LABELS)
    out = toxicity.toxicity_report(frame(rows), labels).collect()
    assert len(out) == len(rows)
    score = {r["doc_id"]: r["score"] for r in out}
    assert score[40] >= 0.3 > score[41] and score[4] == score[5] == score[6]
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        d = r["doc_id"]
        assert r["held_out"] == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2)
    empty = spark.createDataFrame([], LABELS)
    assert toxicity.toxicity_report(frame([]), empty).collect() == []
    kept = toxicity.clean_documents(frame(rows), empty)
    assert kept.columns == frame(rows).columns and 40 not in {r["doc_id"] for r in kept.collect()}


def test_terms_match_at_word_borders():
    matcher = Matcher([Term("trash", False), Term("lowe", True)])
    assert dict(matcher.hits("trash, trashy; a trash")) == {0: 2}
    assert dict(matcher.hits("loweich blowe lowe")) == {1: 2}
    assert not Matcher([]).hits("trash")


def test_word_beginnings_are_mined(spark):
    rows = [(i, f"plain words about things {i} with badro{'abcdefgh'[i % 8]}{i} in it" if i < 12 else f"plain words about things {i}", int(i < 12))
            for i in range(200)]
    terms = toxicity.mined_terms(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    stems = {t.text for t in terms if t.stem}
    assert "badro" in stems and all(len(s) in toxicity.STEMS and "badro".startswith(s[:4]) for s in stems)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.15
    vote = lambda hit, false: (rng.random(4000) < np.where(y, hit, false)).astype(float)
    a, b, c = vote(0.8, 0.02), vote(0.6, 0.05), vote(0.7, 0.01)
    copy = np.where(rng.random(4000) < 0.95, b, 1 - b)
    model = LabelModel()
    noisy = np.where(rng.random(4000) < 0.97, y, ~y).astype(float)
    q = model.fit(np.stack([a, b, c, copy], 1), noisy)
    assert ((q > 0.5) == y).mean() > 0.97
    assert model.correlation[1, 3] > 0.6 > abs(model.correlation[0, 2])
    pairs = {frozenset(p) for p in model.tree if p[1] is not None}
    assert frozenset((1, 3)) in pairs
    # The annotator's rates are found as well.
    assert np.allclose(model.annotator, [0.03, 0.97], atol=0.03)


def test_annotators_of_different_accuracy_get_different_rates():
    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.3
    vote = lambda hit, false: (rng.random(6000) < np.where(y, hit, false)).astype(float)
    votes = np.stack([vote(0.85, 0.05), vote(0.8, 0.04), vote(0.9, 0.06)], 1)
    for hit, false in ((0.95, 0.02), (0.75, 0.1)):
        model = LabelModel()
        q = model.fit(votes, vote(hit, false))
        assert np.allclose(model.annotator, [false, hit], atol=0.05)
        assert ((q > 0.5) == y).mean() > 0.95


def test_posteriors_equal_those_of_plain_enumeration():
    """A small vote table: the fixed point's posteriors from the rates, row by row,
    by the product of p(vote | parent's vote, y) over the tree."""
    rng = np.random.default_rng(2)
    y = rng.random(300) < 0.4
    votes = np.stack([(rng.random(300) < np.where(y, h, f)).astype(float) for h, f in ((0.8, 0.1), (0.7, 0.2), (0.9, 0.3))], 1)
    marks = (rng.random(300) < np.where(y, 0.9, 0.05)).astype(float)
    model = LabelModel(rounds=500)
    q = model.fit(votes, marks)
    weights = {0: 1 - q, 1: q}

    def share(label, *conditions):
        """Smoothed weight of the rows where all (votes, value) hold, as in the model."""
        ok = np.ones(len(q), bool)
        for v, value in conditions:
            ok &= votes[:, v] == value
        return weights[label][ok].sum()

    for i in range(0, 300, 7):
        odds = {}
        for label in (0, 1):
            p = model.prior if label else 1 - model.prior
            p *= model.annotator[label] if marks[i] else 1 - model.annotator[label]
            for v, parent in model.tree:
                mine = votes[i, v]
                if parent is None:
                    p *= (share(label, (v, mine)) + 0.1) / (weights[label].sum() + 0.2)
                else:
                    theirs = votes[i, parent]
                    p *= ((share(label, (parent, theirs), (v, mine)) + 0.1)
                          / (share(label, (parent, theirs)) + 0.2))
            odds[label] = p
        assert abs(odds[1] / (odds[0] + odds[1]) - q[i]) < 0.01


def test_sample_has_one_row_for_a_labelled_id_that_repeats(spark, frame):
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != toxicity.HELD_OUT_FOLD]
    rows = [(i, f"text {i}") for i in ids[1:]] + [(ids[0], f"another text {i}") for i in range(100)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], LABELS)
    sample = toxicity.labelled_sample(frame(rows), labels).collect()
    assert sorted(r["doc_id"] for r in sample) == ids
    assert all((r["doc_id"], r["text"]) in rows and r["toxic"] == r["doc_id"] % 2 for r in sample)
    assert len(toxicity.labelled_sample(frame(rows), labels, 5).collect()) == 5
