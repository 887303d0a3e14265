"""The communication matrix against exact probabilities, and the shuffle's law on all small cases."""

import math
from collections import Counter
from itertools import product

import numpy as np

from vigil.llm import sharding


def test_draws_follow_the_exact_probabilities():
    rng = np.random.default_rng(1)
    for good, bad, n in [(3, 4, 3), (10, 2, 5), (1, 30, 7), (6, 6, 12), (8, 5, 1), (0, 5, 2), (5, 0, 3)]:
        times = 20_000
        got = Counter(sharding.hypergeometric(rng, good, bad, n) for _ in range(times))
        for k in range(0, n + 1):
            p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
            assert abs(got[k] / times - p) < 5 * math.sqrt(p * (1 - p) / times) + 1e-9


def test_every_matrix_comes_as_often_as_it_should():
    """Counts (3, 2) over two shards of 3 and 2 rows: all matrices with these sums, by the exact number of deals."""
    times = 12_000
    got = Counter(tuple(sharding.communication_matrix([3, 2], 2, seed)[:, 0]) for seed in range(times))
    ways = {(a, 3 - a): math.comb(3, a) * math.comb(2, 3 - a) for a in range(4) if 0 <= 3 - a <= 2}
    assert set(got) == set(ways)
    for k, w in ways.items():
        p = w / sum(ways.values())
        assert abs(got[k] / times - p) < 5 * math.sqrt(p * (1 - p) / times)


def test_matrices_have_their_sums():
    for counts, shards in product([[0], [5], [1, 0, 7], [20_000, 3, 19_999], [1] * 50], [1, 2, 24]):
        m = sharding.communication_matrix(counts, shards, 3)
        assert m.sum(axis=1).tolist() == counts and (m >= 0).all()
        assert m.sum(axis=0).max() - m.sum(axis=0).min() <= 1
