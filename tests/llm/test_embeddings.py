import numpy as np

from stockroom.llm import embeddings


def brute(rows, threshold=0.93):
    def usable(x, label):
        return label is not None and x and None not in x and np.isfinite(x).all() and np.any(x)

    n = len(rows)
    near = np.zeros((n, n), bool)
    for a, (_, x, la) in enumerate(rows):
        for b, (_, y, lb) in enumerate(rows):
            if a != b and la == lb and usable(x, la) and usable(y, lb) and len(x) == len(y):
                u, v = (np.array(z, np.float32).astype(float) for z in (x, y))
                near[a, b] = u @ v / np.sqrt((u @ u) * (v @ v)) >= threshold
    group = list(range(n))
    for a in range(n):
        for b in np.flatnonzero(near[a]):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    ids = [r[0] for r in rows]
    first = {g: min(ids[i] for i in range(n) if group[i] == g) for g in set(group)}
    return sorted((ids[i], int(near[i].sum()), first[group[i]]) for i in range(n))


def test_clusters_chains_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "LEAF", 16)
    rng = np.random.default_rng(1)
    rows = []
    for label in (1, 2):
        for _ in range(8):
            centre = rng.standard_normal(12)
            rows += [((centre + 0.18 * rng.standard_normal(12)).tolist(), label) for _ in range(12)]
    hot = rng.standard_normal(12)
    rows += [((hot + 0.01 * rng.standard_normal(12)).tolist(), 1) for _ in range(60)]
    rows += [(hot.tolist(), 1)] * 5 + [(hot.tolist(), None), (hot.tolist()[:5], 1), (hot.tolist()[:5], 1)]
    rows += [(None, 1), ([], 1), ([0.0] * 12, 1), ([0.0] * 12, 1), ([float("nan")] * 12, 2), ([1.0] * 11 + [None], 2), ([float("inf")] * 12, 2)]
    rows += [([float(np.cos(t)), float(np.sin(t))], 3) for t in np.arange(0, 3, 0.3)]  # a chain of links
    rows = [(i, x, label) for i, (x, label) in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embeddings.near_vectors(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_vectors(df.where("false")).count() == 0


def test_links_between_two_dense_groups(spark):
    rng = np.random.default_rng(2)
    axes = np.linalg.qr(rng.standard_normal((24, 24)))[0]

    def pair(cosine, label, n=60):
        centres = axes[0], cosine * axes[0] + np.sqrt(1 - cosine**2) * axes[1]
        return [((c + 0.001 * rng.standard_normal(24)).tolist(), label) for c in centres for _ in range(n)]

    rows = pair(0.94, 1) + pair(0.92, 2)  # the second two groups are joined by one vector between them
    rows.append(((axes[0] + (0.92 * axes[0] + np.sqrt(1 - 0.92**2) * axes[1])).tolist(), 2))
    rows = [(i, x, label) for i, (x, label) in enumerate(rows)]
    want = brute(rows)
    assert {n for i, n, _ in want if i < 120} == {119} and {c for _, _, c in want} == {0, 120}
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want


def test_dense_groups_of_several_leaves(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF", 16)
    monkeypatch.setattr(embeddings, "missed_links", lambda *_: (0, 0))  # without the help of the audit
    rng = np.random.default_rng(3)
    axes = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    centres = axes[0], 0.94 * axes[0] + np.sqrt(1 - 0.94**2) * axes[1]
    rows = [(i, (centres[i % 2] + 0.001 * rng.standard_normal(24)).tolist(), 1) for i in range(120)]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), rounds=3).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def test_doubles_keep_their_precision_and_other_columns_are_not_read(spark):
    edge = [0.93, float(np.sqrt(1 - 0.93**2))]
    rows = [(1, [1e39, 0.0], 1), (2, [2e39, 0.0], 1), (3, [1.0, 0.0], 2), (4, edge, 2), (5, [1.0, 0.0], 3), (6, [0.93 - 1e-9, edge[1] + 1e-8], 3)]
    df = spark.createDataFrame([(*r, "x", b"y") for r in rows], "vec_id long, embedding array<double>, label int, node string, vector binary")

    def cosine(x, y):
        return float(np.dot(np.array(x) / np.abs(x).max(), np.array(y) / np.abs(y).max()) / np.linalg.norm(np.array(x) / np.abs(x).max()) / np.linalg.norm(np.array(y) / np.abs(y).max()))

    want = {1: 1, 2: 1, 3: int(cosine(rows[2][1], rows[3][1]) >= 0.93), 5: int(cosine(rows[4][1], rows[5][1]) >= 0.93)}
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    assert {k: got[k] for k in want} == want and want[5] == 0
