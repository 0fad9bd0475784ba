import numpy as np
import pytest

from brokerhouse.llm import hard_negatives
from brokerhouse.llm.hard_negatives import Block, Query, encode, exact_products, rotate, score_range

NAMES = "vec_id long, embedding array<double>, label int, rank int"


def whole(vector):
    return [int(np.floor(256 * x)) for x in vector]


def brute(rows):
    """Every pair, in Python's whole numbers."""
    known = [(i, whole(v), y) for i, v, y, _ in rows if v and y is not None and all(x is not None and np.isfinite(x) for x in v)]
    known = [(i, v, (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in known]
    out = []
    for n, (i, v, y) in enumerate(known):
        if i is None or i % 50:
            continue
        scored = [
            (-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63)), 2**63 - 1), j is None, j or 0, z)
            for m, (j, w, z) in enumerate(known)
            if m != n and len(w) == len(v)
        ]
        scored.sort(key=lambda s: s[:3])
        for p, p_null, positive, _ in [s for s in scored if s[3] == y][:5]:
            hard = [s for s in scored if s[3] != y and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(i, None if p_null else positive, k + 1, None if null else j, -p, -s) for k, (s, null, j, _) in enumerate(hard)]
    return sorted(out, key=str)


def rows_of(rng, n, dim):
    centers = rng.normal(0, 0.12, (4, dim))
    return [(k, (centers[k % 4] + rng.normal(0, 0.1, dim)).tolist(), int(rng.integers(0, 4)), 0) for k in range(n)]


@pytest.mark.parametrize("block_rows", [None, 40])
def test_mining_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    rows = rows_of(rng, 400, 20)
    rows += [(500 + k, rows[50][1], k % 3, 0) for k in range(25)]  # ties
    rows += [(50, rows[7][1], 1, 0), (100, *rows[100][1:]), (None, rows[3][1], 2, 0), (None, rows[3][1], 2, 0)]
    rows += [(1000, None, 1, 0), (1050, [None, 1.0], 1, 0), (1100, [float("nan")] * 20, 1, 0), (1150, [float("inf")] * 20, 1, 0)]
    rows += [(1200, [], 1, 0), (1250, rows[0][1], None, 0), (1300, [0.0] * 20, 3, 0)]
    rows += [(1500 + k, [2.0 ** (900 - 100 * k), 1.0], k % 2, 0) for k in range(0, 200, 10)]  # beyond the range of a long
    rows += [(2000 + k, rng.normal(0, 0.2, 3).tolist(), k % 2, 0) for k in range(60)]
    docs = spark.createDataFrame(rows, NAMES).repartition(5)
    found = hard_negatives.mine(hard_negatives.shifted_labels(docs), block_rows=block_rows)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], NAMES)
    assert hard_negatives.mine(empty).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(50, [1.0], 0, 0), (51, [1.0], 1, 0)], NAMES)).count() == 0


def test_huge_components_end_at_the_range_of_a_long():
    rows = np.floor(256 * np.array([[2.0**40, 1.0], [-(2.0**40), 3.0], [2.0**24, 2.0**23], [0.5, 0.25], [1e300, 1e300]]))
    for vector in rows:
        exact = [sum(int(a) * int(b) for a, b in zip(row, vector, strict=True)) for row in rows]
        assert exact_products(rows, vector).tolist() == [min(max(x, -(2**63)), 2**63 - 1) for x in exact]
        assert exact_products(rows[3:4], rows[3]).tolist() == [128 * 128 + 64 * 64]


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_intervals_hold_every_score(dim):
    rng = np.random.default_rng(dim)
    rows = np.floor(256 * np.concatenate([rng.normal(0, 0.3, (300, dim)), rng.standard_cauchy((60, dim)), np.zeros((1, dim))]))
    assert np.allclose(rotate(rows) @ rotate(rows[:5]).T, rows @ rows[:5].T)
    block = Block(np.arange(len(rows)), np.arange(len(rows)), np.ones(len(rows), bool), np.zeros(len(rows)), rows, *encode(rows))
    widths = []
    for vector in rows[::7]:
        some, sums, query = np.arange(len(rows)), 0.0, Query(rotate(vector[None])[0])
        for level in range(len(block.codes)):
            sums, low, high = block.refine(query, level, some, sums)
            scores = rows @ vector
            assert (low <= scores).all() and (scores <= high).all()
            widths.append((level, float((high - low).mean())))
    by_level = [np.mean([w for k, w in widths if k == level]) for level in range(len(block.codes))]
    assert all(b < a for a, b in zip(by_level, by_level[1:]))


def test_codes_rule_out_most_pairs():
    """Random directions, where nothing but the codes helps: under a fifth of the pairs are scored."""
    rng = np.random.default_rng(9)
    rows = np.floor(256 * rng.normal(0, 0.125, (6000, 64)))
    block = Block(np.arange(6000), np.arange(6000), np.ones(6000, bool), np.zeros(6000), rows, *encode(rows))
    turned = rotate(rows[:30])
    for q in range(30):
        exact = rows @ rows[q]
        exact[q] = -np.inf
        ((some, scores),) = block.search(q, rows[q], turned[q], [slice(0, 6000)], [(-(1 << 63), (1 << 63) - 1)], 5)
        assert some.tolist() == np.lexsort((np.arange(6000), -exact))[:5].tolist() and (scores == exact[some]).all()
    assert block.scored < 0.2 * block.pairs


def test_ranges_are_those_of_the_shares():
    for p in [*range(-300, 300), 10**17]:
        least, most = score_range(p, 50, 95)
        near = [s for s in range(least - 3, least + 4)] + [s for s in range(most - 3, most + 4)]
        assert all((50 * p <= 100 * s <= 95 * p) == (least <= s <= most) for s in near)
