"""The forest against all pairs."""

import numpy as np
import pytest
from parcelsight.llm import forest as f


def plain(rows, least=f.LEAST):
    able = {}
    for at, (_, vector, label) in enumerate(rows):
        if label is None or not vector or any(x is None for x in vector):
            continue
        v = np.array(vector, float)
        if np.isfinite(v).all() and v.any():
            able[at] = v / np.linalg.norm(v)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    groups = {}
    for i, v in able.items():
        groups.setdefault((rows[i][2], len(v)), []).append(i)
    for own in groups.values():
        units = np.array([able[i] for i in own])
        for i, cosines in zip(own, units @ units.T):
            for j in np.flatnonzero(cosines >= least):
                if own[j] != i:
                    links[i] += 1
                    root[find(i)] = find(own[j])
    names = {}
    for i in able:
        if rows[i][0] is not None:
            names[find(i)] = min(names.get(find(i), rows[i][0]), rows[i][0])
    name = [names.get(find(i)) if i in able else r[0] for i, r in enumerate(rows)]
    return sorted([(r[0], links[i], name[i], r[0] == name[i]) for i, r in enumerate(rows)], key=str)


def found(spark, rows, **options):
    kinds = "vec_id long, embedding array<float>, label int, node string, leaf long"
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], kinds).repartition(3)
    got = f.linked(table, **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted([tuple(r) for r in got.collect()], key=str)


def planted(rng, n, size, labels, noise=0.05):
    centres = rng.standard_normal((n // 3, size))
    rows = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] + noise * np.sqrt(size) * rng.standard_normal(size) * rng.random()
        rows.append((i, np.float32(v).tolist(), int(rng.integers(labels))))
    return rows


def test_odd_vectors_ties_and_repeated_rows(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.1], 2), (5, [1.0, 0.0, 0.0], 1),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [1.0, float("nan")], 1), (11, [1.0, float("inf")], 1),
        (12, [1.0, 0.0], None), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (None, None, None),
        (13, [-0.0, 1.0], 3), (14, [0.0, 1.0], 3), (15, [1e-30, 1e-30], 4), (16, [1e30, 1e30], 4), (17, [-1e30, -1e30], 4),
    ]
    assert found(spark, rows) == plain(rows)


def test_an_empty_table_and_one_vector(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, [1.0], 0)]) == [(5, 0, 5, True)]


def test_small_groups_are_exact(spark):
    rows = planted(np.random.default_rng(1), 300, 16, 3)
    assert found(spark, rows) == plain(rows)


def test_recall_of_a_large_group(spark):
    rng = np.random.default_rng(2)
    rows = planted(rng, 2_500, 32, 1, noise=0.09)
    want, got = {r[0]: r for r in plain(rows)}, {r[0]: r for r in found(spark, rows)}
    assert all(got[i][1] <= want[i][1] for i in want)
    assert sum(r[1] for r in got.values()) >= 0.999 * sum(r[1] for r in want.values())
    assert sum(got[i][2] == want[i][2] for i in want) >= 0.999 * len(want)


def test_a_dense_group_larger_than_a_block(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(24)
    rows = [(i, np.float32(centre + 0.15 * rng.standard_normal(24)).tolist(), 1) for i in range(1_300)]
    rows += [(i, rng.standard_normal(24).tolist(), 1) for i in range(1_300, 1_500)]
    assert found(spark, rows) == plain(rows)


def test_many_copies_are_one_node(spark):
    rng = np.random.default_rng(4)
    rows = planted(rng, 200, 8, 2)
    rows += [(1_000 + i, rows[0][1], rows[0][2]) for i in range(1_500)]
    got = {r[0]: r for r in found(spark, rows)}
    assert got[1_000][1] >= 1_500 and got[1_500][1:3] == got[1_000][1:3] == got[0][1:3]


def test_pairs_at_the_bound_keep_their_side():
    left = np.array([[1.0, 0.0]])
    for cosine, want in ((0.93, True), (0.92999999, False), (0.93000001, True)):
        right = np.array([[cosine, np.sqrt(1 - cosine * cosine)]])
        assert bool(f._linked(left, right, 0.93 - 1e-15 if cosine == 0.93 else 0.93)[0, 0]) is want


def test_the_overlap_keeps_what_it_promises():
    rng = np.random.default_rng(5)
    size = 64
    a = rng.standard_normal((20_000, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = f.LEAST * a + np.sqrt(1 - f.LEAST**2) * side
    along, other = a @ f.direction(1, size), b @ f.direction(1, size)
    middle, gap = np.median(along), f.spread(f.LEAST, size)
    width = f.half_width(float(np.mean(np.abs(along - middle) <= gap / 2)), gap)
    low, high = np.minimum(along, other), np.maximum(along, other)
    parted = (low < middle - width) & (high >= middle + width)
    assert 0 < width < 0.2 and parted.mean() <= 1.2 * f.MISS


@pytest.mark.parametrize("leaf", [50, 400])
def test_every_vector_reaches_a_leaf_of_its_cell(leaf):
    units = np.random.default_rng(6).standard_normal((2_000, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    splits = {p: (seed, at, width) for _, p, seed, at, width in f.fitted(units, 2_000, 0, "", 0.99, leaf)}
    cells = list(f.routed(units, splits, ""))
    assert len(cells) > 1 and set(np.concatenate([own for _, own in cells])) == set(range(2_000))
