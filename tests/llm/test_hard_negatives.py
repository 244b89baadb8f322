"""Strassen products and hard negatives against brute force."""

import numpy as np
import pytest

from prismcube.llm import hard_negatives as hard
from prismcube.llm.queries import op12_hard_negatives

VECTOR = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (0, 3, 2), (2, 0, 3), (5, 7, 3), (64, 64, 64), (65, 66, 67), (129, 40, 200), (17, 100, 250)])
@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_product_is_exact(shape, leaf):
    draw = np.random.default_rng(sum(shape))
    a = draw.integers(-(1 << 24), 1 << 24, shape[:2])
    b = draw.integers(-(1 << 24), 1 << 24, shape[1:])
    assert (hard.strassen(a, b, leaf) == a @ b).all()
    # Sums in between may wrap around; the result doesn't.
    assert (hard.strassen(a << 7, b << 7, leaf) == (a << 7) @ (b << 7)).all()


def test_components():
    big = hard.BOUND
    rows = hard.scaled([np.array([0.5, -0.001, 1e30]), np.array([]), np.array([-1e30, 1.0])])
    assert rows.tolist() == [[128, -1, big], [0, 0, 0], [-big, 256, 0]]


def test_heaps_merge():
    draw = np.random.default_rng(5)
    scores, ids = draw.integers(0, 30, 200), draw.permutation(200)
    heaps = hard.Heaps(7)
    for part in np.array_split(np.arange(200), 9):
        found = hard.best(scores[part], ids[part], np.ones(len(part), dtype=bool), 7)
        heaps.push("x", ids[part][found], scores[part][found])
    order = np.lexsort((ids, -scores))[:7]
    assert heaps.held["x"][0].tolist() == ids[order].tolist() and heaps.held["x"][1].tolist() == scores[order].tolist()


def plain_negatives(rows, every=100, k=5):
    used = []
    for i, v, label in rows:
        if label is not None and v is not None and None not in v and np.isfinite(v).all():
            if i is not None and i % 7 == 0:
                label = (label + 1) % 10
            used.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    out = []
    for a, (i, q, label) in enumerate(used):
        if i is None or i % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, v, strict=False)), hard.NO_ID if j is None else j, same == label)
            for b, (j, v, same) in enumerate(used) if b != a
        )
        for minus, j, _ in [s for s in scored if s[2]][:k]:
            near = [s for s in scored if not s[2] and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:k]
            for rank, (other, n, _) in enumerate(near, 1):
                out.append((i, None if j == hard.NO_ID else j, rank, None if n == hard.NO_ID else n, -minus, -other))
    return sorted(out, key=repr)


def shown(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_negatives_of_awkward_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.integers(-2, 6, 5) / 8], int(draw.integers(0, 3))) for i in range(0, 420, 2)]
    rows += [(i, [0.25] * 5, i % 2) for i in range(501, 541)]  # ties
    rows += [(300, [0.5, 0.5, 0.1, 0.2, 0.3], 1), (300, [0.5, 0.5, 0.1, 0.2, 0.3], 1)]  # equal anchors
    rows += [(600, None, 1), (700, [0.1, None], 1), (800, [float("nan")], 1), (900, [float("inf")], 2), (1000, [0.5] * 5, None)]
    rows += [(None, [0.5] * 5, 0), (None, [0.5] * 5, 1), (1100, [], 2), (1200, [0.75], 1), (1300, [0.5] * 9, 2), (2, [0.0] * 5, 12)]
    frame = spark.createDataFrame(rows, VECTOR)
    clash = frame.selectExpr("*", "'clash' as score", "1 as rank", "2 as part", "3 as block", "4 as place")
    wanted = plain_negatives(rows)
    assert len(wanted) > 50
    assert shown(hard.hard_negatives(hard.with_wrong_labels(clash))) == wanted
    # Small tiles, so that heaps of many of them merge, also within a partition.
    assert shown(hard.hard_negatives(hard.with_wrong_labels(clash), anchors=2, candidates=16)) == wanted
    # Positives that score below zero leave no window.
    assert not any(r[4] < 0 for r in wanted)


def test_wide_vectors_make_smaller_blocks(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.integers(0, 8, 40) / 16], i % 3) for i in range(0, 300, 5)]
    monkeypatch.setattr(hard, "COMPONENTS", 200)
    assert shown(hard.hard_negatives(hard.with_wrong_labels(spark.createDataFrame(rows, VECTOR)))) == plain_negatives(rows)


def test_few_or_no_vectors(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (3, [1.0], 1)], [(0, [1.0], 0), (2, [1.0], 1)]):
        assert hard.hard_negatives(spark.createDataFrame(rows, VECTOR)).count() == 0
    rows = [(0, [1.0], 1), (3, [1.0], 1), (4, [1.0], 2), (5, [0.79], 2)]
    assert shown(hard.hard_negatives(spark.createDataFrame(rows, VECTOR))) == [(0, 3, 1, 4, 65536, 65536)]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert shown(op12_hard_negatives(spark, folder)) == plain_negatives(rows)
