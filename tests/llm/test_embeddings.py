import numpy as np

from cadence.llm import embeddings


def plain(rows, threshold):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v, g) else None for _, v, g in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
               and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        group = [min([group[i], *(group[j] for j in linked[i])]) for i in range(n)]
    least = {}
    for i, g in enumerate(group):
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], len(linked[i]), least.get(group[i])) for i in range(n)), key=str)


def vectors(seed=0, n=160, d=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = (centres[i % 12] + rng.normal(size=d) * rng.choice([0.05, 0.25, 0.35])).astype(np.float32)
        rows.append((i, v.tolist(), i % 3))
    return rows


def test_report_equals_brute_force(spark):
    rows = vectors() + [
        (500, None, 1), (501, [0.0] * 24, 1), (502, [1.0] * 24, None), (503, [1.0] * 23 + [None], 1),
        (504, [float("nan")] + [1.0] * 23, 1), (505, [float("inf")] + [1.0] * 23, 1), (506, [], 1), (507, [1.0, 2.0], 1),
        (508, [2.0, 4.0], 1), (None, [1.0, 2.0], 1), (509, vectors()[4][1], 1), (510, vectors()[4][1], 1), (510, vectors()[4][1], 1),
        (511, [1e30] * 24, 2), (512, [1e-30] * 24, 2),
    ]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, key string")
    for threshold in (0.93, 0.8):
        got = embeddings.near_duplicates(frame, threshold=threshold).collect()
        assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == plain(rows, threshold)
    for r in got:
        assert r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"])
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


def test_small_tiles_give_the_same(spark):
    frame = spark.createDataFrame(vectors(3), "vec_id long, embedding array<float>, label int")
    different = embeddings.written(embeddings.different_vectors(embeddings._keyed(frame, "vec_id", "embedding", "label")), "v")

    def sums(tile):
        out = {}
        for r in embeddings.links(different, 0.9, tile).where("b is null").collect():
            out[bytes(r["a"])] = out.get(bytes(r["a"]), 0) + r["links"]
        return out
    assert sums(7) == sums(1000) and sums(7)


def test_bound_is_rigorous():
    rng = np.random.default_rng(1)
    unit = embeddings._unit(rng.normal(size=(300, 40)) ** 3)
    codes, scale, norm, error = embeddings.quantised(unit)
    near = embeddings.tile_products(codes, codes) * scale[:, None] * scale[None, :]
    bound = norm[:, None] * error[None, :] + error[:, None] * norm[None, :] + error[:, None] * error[None, :]
    assert (np.abs(unit @ unit.T - near) <= bound + 1e-12).all()


def test_long_vectors_are_summed_in_parts():
    rng = np.random.default_rng(2)
    codes = rng.integers(-127, 128, (3, 5000)).astype(np.int8)
    assert (embeddings.tile_products(codes, codes) == codes.astype(np.int64) @ codes.astype(np.int64).T).all()


def test_pairs_within_the_bound_are_decided_in_doubles(spark):
    """Cosines spread closely around the threshold, where the codes cannot tell."""
    rng = np.random.default_rng(9)
    d, threshold = 16, 0.93
    base = rng.normal(size=d)
    base /= np.linalg.norm(base)
    rows = [(0, base.tolist(), 1)]
    for i in range(1, 120):
        away = rng.normal(size=d)
        away -= away @ base * base
        away /= np.linalg.norm(away)
        cosine = threshold + rng.choice([-1, 1]) * 10.0 ** rng.uniform(-9, -2)
        rows.append((i, (3.7 * (cosine * base + np.sqrt(1 - cosine ** 2) * away)).tolist(), 1))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embeddings.near_duplicates(frame, threshold=threshold).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == plain(rows, threshold)
    assert 20 < next(r["n_links"] for r in got if r["vec_id"] == 0) < 100
