"""The draws of operator 2: law, sums and size of what can be drawn."""

from math import comb

import numpy as np
import pytest

from nutq.llm import mixing


@pytest.mark.parametrize("good, bad, n", [(5, 7, 4), (5, 7, 9), (1, 40, 20), (40, 1, 21), (3, 3, 6), (0, 5, 2), (5, 0, 2), (30, 50, 33)])
def test_small_draws_follow_the_exact_law(good, bad, n):
    times = 40_000
    full = lambda x: np.full(times, x, np.int64)
    got = np.bincount(mixing.hypergeometric(np.random.default_rng(1), full(good), full(bad), full(n)), minlength=n + 1) / times
    want = np.array([comb(good, k) * comb(bad, n - k) for k in range(n + 1)]) / comb(good + bad, n)
    assert np.abs(got - want).max() < 5 * 0.5 / times**0.5


@pytest.mark.parametrize("good, bad, n", [(10**8, 3 * 10**8, 10**8), (10**10, 3 * 10**10, 10**9), (10**12, 10**12, 10**12), (10**5, 10**12, 4 * 10**11), (3 * 10**4, 5 * 10**4, 4 * 10**4)])
def test_large_draws_have_the_mean_and_spread_of_the_law(good, bad, n):
    times = 20_000
    full = lambda x: np.full(times, x, np.int64)
    got = mixing.hypergeometric(np.random.default_rng(2), full(good), full(bad), full(n)).astype(float)
    every, share = good + bad, good / (good + bad)
    spread = (n * share * (1 - share) * (every - n) / (every - 1)) ** 0.5
    assert abs(got.mean() - n * share) < 5 * spread / times**0.5
    assert abs(got.std() / spread - 1) < 0.03


def test_ten_billion_slots_of_fifty_thousand_sources():
    slots = np.random.default_rng(3).integers(0, 400_000, 50_000)
    slots[7], slots[8] = 0, 4 * 10**9
    assert slots.sum() > 10**10
    groups = 1 << 20
    found = list(mixing.group_counts(slots, groups, 77_000, 77_003))
    assert [g for g, _, _ in found] == [77_000, 77_001, 77_002]
    for (_, left, before), (_, _, after) in zip(found, found[1:], strict=False):
        assert (before + left == after).all() and (left >= 0).all() and (after <= slots).all()
    again = list(mixing.group_counts(slots, groups, 77_001, 77_002))
    assert (again[0][1] == found[1][1]).all() and (again[0][2] == found[1][2]).all()
    assert found[0][1][7] == 0


def test_groups_take_every_slot_once():
    slots = np.array([1000, 0, 1, 77, 31_000], np.int64)
    parts = [left for _, left, _ in mixing.group_counts(slots, 13, 0, 13)]
    assert (sum(parts) == slots).all()
    assert max(int(p.sum()) for p in parts) - min(int(p.sum()) for p in parts) <= 1
