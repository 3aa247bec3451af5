"""The configuration LP of packing: covering constraints, bound, share placed."""

import numpy as np
import pytest

from bookshift.llm import packing


def lengths_like_texts(scale):
    """1,883 different lengths, short ones commoner."""
    rng = np.random.default_rng(2)
    counts = np.zeros(packing.CAPACITY + 1, np.int64)
    for l in rng.permutation(np.arange(1, packing.CAPACITY))[:1883]:
        counts[l] = (1 + rng.poisson(12 * np.exp(-l / 600))) * scale
    return counts


@pytest.mark.parametrize("scale", [1, 1000])
def test_plan_covers_nearly_all_tokens(scale):
    counts = lengths_like_texts(scale)
    plan = packing.solve(counts)
    covered = np.zeros_like(counts, dtype=float)
    for shape, x in plan.items():
        assert sum(shape) <= packing.CAPACITY and x == int(x) >= 1
        for l in shape:
            covered[l] += x
    assert (covered <= counts + 1e-6).all()
    lengths = np.arange(packing.CAPACITY + 1)
    assert covered @ lengths >= (1 - packing.TOLERANCE) * (counts @ lengths)
    assert covered.sum() >= 0.9 * counts.sum()
    assert len(plan) <= 1883 / packing.STEP + 1
    bound = packing.lower_bound(counts)
    used = sum(times for _, times in packing.pack(counts))
    assert bound <= used <= bound * 1.005 + 1


def test_bound_is_no_more_than_an_optimal_packing():
    """Three pieces of more than half a sequence need three: prices that know
    it say so, prices by length say less, none says more."""
    counts = np.zeros(11, np.int64)
    counts[6] = 3
    half = np.where(np.arange(11) > 5, 1.0, 0.0)
    assert packing.lower_bound(counts, 10) == pytest.approx(3) == packing.lower_bound(counts, 10, half)
    counts[4] = 1
    assert packing.lower_bound(counts, 10, half) == pytest.approx(3)
    assert packing.lower_bound(counts, 10) <= 3 + 1e-9
    assert sum(t for _, t in packing.pack(counts, 10)) == 3


def test_empty_table_and_single_lengths():
    none = np.zeros(packing.CAPACITY + 1, np.int64)
    assert packing.solve(none) == {} and packing.pack(none) == [] and packing.lower_bound(none) == 0
    none[1] = 10**9
    assert sum(t for _, t in packing.pack(none)) == -(-(10**9) // packing.CAPACITY)
