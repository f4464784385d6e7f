import re

import numpy as np
import pyarrow as pa
import pytest

from cadence.llm import jaccard_forest as forest
from cadence.llm.blocks import forest as spanning
from cadence.llm.components import components
from cadence.llm.words import Words


def plain(rows, threshold=0.8):
    """(links, class) of each row by its place."""
    sets, texts = [], [t or "" for _, t in rows]
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    n = len(rows)
    linked = [[j for j in range(n) if j != i and (texts[i] == texts[j] or (
        sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold))] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        group = [min([group[i], *(group[j] for j in linked[i])]) for i in range(n)]
    least = {}
    for i, g in enumerate(group):
        d = rows[i][0]
        least[g] = min(least.get(g, (float("inf"), None)), (float("-inf") if d is None else d, d), key=lambda x: x[0])
    return [(rows[i][0], least[group[i]][1], len(linked[i])) for i in range(n)]


def near_copies(seed=3, n=12, size=120):
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 10**6, size)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.integers(0, size, i % 4):
            words[at] = f"e{i}x{at}"
        rows.append((100 + i, " ".join(words)))
    return rows


def test_report_equals_brute_force(frame, odd_rows):
    rows = odd_rows + near_copies() + [(200, rows_text) for _, rows_text in near_copies(4, 3)]
    got = forest.join_report(frame(rows)).select("doc_id", "class_id", "n_links").collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(plain(rows), key=key)


def test_one_of_each_keeps_one_row_a_class(frame, odd_rows):
    docs = frame(odd_rows)
    out = forest.one_of_each(docs)
    assert out.columns == docs.columns
    # The null id and 7 stand for two classes each.
    assert out.count() == len({c for _, c, _ in plain(odd_rows)}) + 2
    assert forest.join_report(frame([])).collect() == []


def test_trees_of_every_length_reach_the_recall():
    """Measured on pairs whose places agree at the threshold's rate: each length
    misses its share of the target or less, and one tree less would not do."""
    rng = np.random.default_rng(21)
    agree = rng.random((100_000, forest.PLACES)) < forest.THRESHOLD
    share = (1 - forest.TARGET_RECALL) / len(forest.LENGTHS)
    for length in forest.LENGTHS:
        trees = forest.trees_for(length)
        assert forest.missed(length, trees) <= share < forest.missed(length, trees - 1)
        met = np.zeros(len(agree), bool)
        for t in range(trees):
            places = forest.tree_places(t)
            assert len(set(places.tolist())) == max(forest.LENGTHS)
            met |= agree[:, places[:length]].all(1)
        assert (~met).mean() < 2.5 * share


def test_overlaps_are_exact():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(9)]
    got = forest.overlaps(sets, np.arange(4), np.arange(4, 9))
    assert got.tolist() == [[len(np.intersect1d(sets[i], sets[j])) for j in range(4, 9)] for i in range(4)]


def test_signatures_estimate_similarity():
    rows = near_copies(9, 4, 400)
    words = Words(pa.array([t for _, t in rows]))
    values, first = forest.shingles(words)
    signs = forest.signatures(values, first)
    sets = [set(values[a:b].tolist()) for a, b in zip(first[:-1], first[1:])]
    for i in range(4):
        for j in range(i):
            true = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            assert abs((signs[i] == signs[j]).mean() - true) < 0.17


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    roots = {r["node"]: r["root"] for r in components(frame).collect()}
    assert {roots[i] for i in range(41)} == {0} and {roots[i] for i in range(200, 260)} == {100}
    assert roots[301] == 300 and len(roots) == 41 + 61 + 2
    assert components(frame.limit(0)).collect() == []


def test_spanning_forest():
    pairs = list(spanning(5, np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4])))
    assert len(pairs) == 3


def edges_of(spark, signs, **limits):
    rows = [(i.to_bytes(16, "big"), 1, s.astype(">u4").tobytes()) for i, s in enumerate(signs)]
    texts = spark.createDataFrame(rows, "key binary, size long, signature binary")
    return {frozenset((int.from_bytes(r["a"], "big"), int.from_bytes(r["b"], "big")))
            for r in forest.candidate_edges(texts, **limits).collect()}


def test_a_pair_that_meets_only_in_a_large_node_is_found(spark):
    """2,500 texts share the first four values of tree 0; two of them agree in 73
    of 96 places, but meet in no other tree."""
    rng = np.random.default_rng(11)
    signs = rng.integers(0, 2**32, (2500, 24, 4), dtype=np.uint32)
    signs[:, 0] = 1
    signs[1, 1:, 1:] = signs[0, 1:, 1:]
    assert edges_of(spark, signs) == {frozenset((0, 1))}


def near_pairs(n, common, agree, seed):
    """Signatures of n texts, ``common`` of whose places agree in all; texts 2i and
    2i + 1 agree in ``agree`` of the other places as well."""
    rng = np.random.default_rng(seed)
    signs = rng.integers(0, 2**32, (n, forest.PLACES), dtype=np.uint32)
    for i in range(0, n, 2):
        at = rng.permutation(np.arange(common, forest.PLACES))[:agree]
        signs[i + 1, at] = signs[i, at]
    order = rng.permutation(forest.PLACES)
    signs[:, :common] = np.arange(common)
    return signs[:, order]


@pytest.mark.parametrize("limit", [1, 8, 10**6])
def test_pairs_in_full_nodes_are_found_by_longer_prefixes(spark, limit):
    signs = near_pairs(400, 48, 29, 22)     # 50 % in common, 80 % in pairs
    pairs = {frozenset((i, i + 1)) for i in range(0, 400, 2)}
    found = edges_of(spark, signs, node_limit=limit)
    # All are found, and no text of a pair is joined to a stranger's.
    assert found == pairs


def test_a_common_passage_costs_less_than_all_its_pairs(spark, monkeypatch):
    """Twice the texts with one passage, far fewer than four times the comparisons."""
    work = {}
    compared = forest._compared

    def counting(met, texts, threshold):
        sizes = met.groupBy("node").count().collect()
        work[now] = work.get(now, 0) + sum(r["count"] * (r["count"] - 1) // 2 for r in sizes)
        return compared(met, texts, threshold)

    monkeypatch.setattr(forest, "_compared", counting)
    for now in (600, 1200):
        found = edges_of(spark, near_pairs(now, 48, 29, 23), node_limit=40)
        assert {frozenset((i, i + 1)) for i in range(0, now, 2)} <= found
    assert work[1200] < 3 * work[600]


def test_a_full_node_of_copies_is_joined_by_its_head(spark, monkeypatch):
    """Near copies only: their nodes need no longer prefix."""
    lengths = []
    labelled = forest.labelled
    monkeypatch.setattr(forest, "labelled", lambda texts, length, trees: lengths.append(length) or labelled(texts, length, trees))
    signs = near_pairs(300, 90, 0, 24)
    found = edges_of(spark, signs, node_limit=50)
    root = list(range(300))
    for _ in range(20):
        for a, b in (tuple(e) for e in found):
            root[a] = root[b] = min(root[a], root[b])
    assert set(root) == {0} and lengths == [4]


def test_report_of_texts_with_a_common_passage_equals_brute_force(frame, monkeypatch):
    monkeypatch.setattr(forest, "NODE_BLOCK", 8)
    rng = np.random.default_rng(12)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for i in range(60):     # 30 pairs about the threshold, all with the passage
        if i % 2 == 0:
            own = [f"o{x}" for x in rng.integers(0, 10**6, 30)]
        words = [*passage, *own[:len(own) - i % 2 * (4 + i // 6)], *(f"e{i}x{x}" for x in range(i % 2 * (4 + i // 6)))]
        rows.append((i, " ".join(words)))
    got = forest.join_report(frame(rows)).select("doc_id", "class_id", "n_links").collect()
    expect = plain(rows)
    assert 0 < sum(n for _, _, n in expect) < 60 * 59
    assert sorted(tuple(r) for r in got) == sorted(expect)


def test_measured_recall_against_brute_force(frame, monkeypatch):
    """Pairs just above the threshold, all with one passage, nodes of any fullness."""
    monkeypatch.setattr(forest, "NODE_LIMIT", 8)
    rng = np.random.default_rng(31)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(0, 300, 2):
        own = [f"o{x}" for x in rng.integers(0, 10**6, 60)]
        rows.append((i, " ".join(passage + own)))
        rows.append((i + 1, " ".join(passage + own[:-8 - i % 5] + [f"e{i}x{x}" for x in range(8 + i % 5)])))
    expect = {d: n for d, _, n in plain(rows)}
    assert sum(expect.values()) > 200
    got = {r["doc_id"]: r["n_links"] for r in forest.join_report(frame(rows)).collect()}
    assert got == expect
