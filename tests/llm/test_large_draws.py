"""Draws from more than 10^9 items follow the hypergeometric law."""

import numpy as np

from dockmill.llm.sharding import _hypergeometric


def test_law_of_large_populations():
    rng = np.random.default_rng(9)
    # Rare: nearly Poisson with mean 0.5, which a rounded, clipped normal law misses.
    rare = np.array([_hypergeometric(rng, 10**6, 2 * 10**12 - 10**6, 10**6) for _ in range(4000)])
    assert np.allclose([(rare == k).mean() for k in range(4)], np.exp(-0.5) * 0.5 ** np.arange(4) / [1, 1, 2, 6], atol=0.035)
    good, bad, n = 3 * 10**9, 7 * 10**9, 10**6
    many = np.array([_hypergeometric(rng, good, bad, n) for _ in range(2000)])
    assert abs(many.mean() - 300_000) < 60 and abs(many.std() / 458.2 - 1) < 0.08
    assert _hypergeometric(rng, 10**10, 5, 10**10 + 5) == 10**10 and _hypergeometric(rng, 5, 10**10, 0) == 0
    assert 0 <= _hypergeometric(rng, 10**10, 5, 10**10) - (10**10 - 5) <= 5
