"""The learnt operators against plain versions: all segmentations, all labellings, plain loops."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from reviewlab.llm import pii, quality, secrets

# -- guess cost: every way to cut a short value ------------------------------------------------


def cheapest(guesser: secrets.Guesser, value: str) -> float:
    """The least cost over all cuts of the value into words, dates, runs, repeats and brute force."""
    low = value.lower()
    plain = low.translate(secrets.LEET)
    pieces: dict[tuple[int, int], list[float]] = {}
    for i, j in itertools.combinations(range(len(value) + 1), 2):
        costs = [sum(secrets._class_cost(c) for c in value[i:j])]
        rank = guesser.rank.get(plain[i:j])
        if rank and j - i >= 3:
            costs.append(math.log10(rank) + (0.0 if value[i:j] == plain[i:j] else 0.6))
        pieces[i, j] = costs
    for m in secrets.DATE.finditer(low):
        pieces[m.start(), m.end(1)].append(4.0 if m.end(1) - m.start() > 4 else 2.0)
    for i, found in enumerate(guesser._runs(low)):
        for j, cost in found:
            pieces[i, j].append(cost)
    for i, found in enumerate(guesser._repeats(low)):
        for period, j in found:
            block = sum(secrets._class_cost(c) for c in value[i : i + period])
            pieces[i, j].append(block + math.log10((j - i) / period))

    def cut(i: int) -> float:
        if i == len(value):
            return 0.0
        return min(
            secrets.NEW_SEGMENT + min(pieces[i, j]) + cut(j) for j in range(i + 1, len(value) + 1)
        )

    return cut(0)


def test_guess_cost_is_the_cheapest_of_all_cuts():
    rng = random.Random(5)
    guesser = secrets.Guesser(["sun", "summer", "pass", "password", "word", "dragon", "abc"])
    parts = ["summer", "p4ss", "Sun", "2019", "20190304", "qwer", "abcd", "xyxy", "aaa", "7#", "Kq", "é"]
    values = ["", "a", "password", "Passw0rd", "sunsun", "qwerty12", "19992000", "aaaaaaaaa", "abcabcabc"]
    values += ["".join(rng.choices(parts, k=3))[:11] for _ in range(60)]
    values += ["".join(rng.choices("ab1!qwe2", k=rng.randint(1, 10))) for _ in range(60)]
    for value in values:
        assert guesser.log10_guesses(value) == pytest.approx(cheapest(guesser, value)), value


def test_runs_and_repeats_by_definition():
    guesser = secrets.Guesser([])
    value = "qwerabcdxyxyxy"
    runs = {(i, j) for i, found in enumerate(guesser._runs(value)) for j, _ in found}
    assert {(0, 4), (4, 8)} <= runs  # keys that touch, letters in order
    for i, found in enumerate(guesser._repeats(value)):
        for period, j in found:
            block = value[i : i + period]
            assert value[i:j] == block * ((j - i) // period) and j - i >= 2 * period
    assert (2, 14) in guesser._repeats(value)[8]


# -- beliefs: every labelling of a small graph -------------------------------------------------


def enumerated(field: pii.Field, phi, edges, skips) -> np.ndarray:
    """Exact label probabilities, from the weight of every labelling."""
    n = len(phi)
    out = np.zeros_like(phi)
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        weight = sum(phi[i, label] for i, label in enumerate(labels))
        for (a, b), skip in zip(edges, skips):
            weight += (field.skip if skip else field.chain)[labels[a], labels[b]]
        for i, label in enumerate(labels):
            out[i, label] += math.exp(weight)
    return out / out.sum(1, keepdims=True)


def graph(seed: int, edges, scale: float):
    rng = np.random.default_rng(seed)
    chain, skip = (scale * rng.normal(size=(pii.LABELS, pii.LABELS)) for _ in range(2))
    nodes = 1 + max(b for _, b in edges)
    field = pii.Field(np.zeros((pii.LABELS, 1)), (chain + chain.T) / 2, (skip + skip.T) / 2)
    skips = np.array([b - a > 1 for a, b in edges])
    return field, rng.normal(size=(nodes, pii.LABELS)), np.array(edges), skips


@pytest.mark.parametrize("edges", [[(0, 1)], [(0, 1), (1, 2), (2, 3)], [(0, 1), (0, 2), (0, 3), (3, 4)]])
def test_beliefs_without_a_loop_are_exact(edges):
    for seed in range(5):
        field, phi, pairs, skips = graph(seed, edges, 1.0)
        got = field.beliefs(phi, pairs, skips, rounds=200)
        assert got == pytest.approx(enumerated(field, phi, pairs, skips), abs=1e-6)


@pytest.mark.parametrize("edges", [[(0, 1), (1, 2), (0, 2)], [(0, 1), (1, 2), (2, 3), (0, 2), (1, 3)]])
def test_beliefs_on_loops_are_near(edges):
    for seed in range(5):
        field, phi, pairs, skips = graph(seed, edges, 0.3)
        exact = enumerated(field, phi, pairs, skips)
        assert field.beliefs(phi, pairs, skips) == pytest.approx(exact, abs=0.05)


def test_a_known_mention_decides_its_repeat():
    """One clamped node pulls the same token elsewhere to its label over a skip edge."""
    field = pii.Field(np.zeros((pii.LABELS, 1)), np.zeros((pii.LABELS,) * 2), 3 * np.eye(pii.LABELS))
    phi = np.zeros((3, pii.LABELS))
    phi[0] = -pii.CLAMP
    phi[0, 3] = pii.CLAMP
    got = field.beliefs(phi, np.array([(0, 1), (1, 2), (0, 2)]), np.array([False, False, True]))
    assert got[2].argmax() == 3 and got[2, 3] > 0.5
    assert got[1] == pytest.approx(np.full(pii.LABELS, 1 / pii.LABELS), abs=1e-6)


# -- boosted trees: plain loops ---------------------------------------------------------------


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 5)), 2)
    x[:, 3] = rng.integers(0, 3, 300)
    y = (x[:, 0] + 0.5 * x[:, 3] + rng.normal(scale=0.5, size=300) > 0.5).astype(float)
    return x, y


def test_flat_traversal_as_a_walk(sample):
    x, y = sample
    trees = quality.grow(x, y)
    got = trees.score(x)
    for row, p in zip(x[:60], got):
        total = trees.start
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += trees.rate * value[node]
        assert p == pytest.approx(1 / (1 + math.exp(-total)))


def best_split(x, g, h):
    """(gain, statistic, rows on the left) of the best cut, tried one after the other."""
    best = (0.0, -1, frozenset())
    whole = g.sum() ** 2 / (h.sum() + quality.SMOOTH)
    for f in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS)[1:-1])):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) < quality.LEAST_ROWS:
                continue
            gain = sum(g[s].sum() ** 2 / (h[s].sum() + quality.SMOOTH) for s in (left, ~left)) - whole
            if gain > best[0] + 1e-9:
                best = (gain, f, frozenset(np.flatnonzero(left)))
    return best


def test_first_split_and_leaves_as_counted(sample):
    x, y = sample
    trees = quality.grow(x, y)
    p = np.full(len(y), y.mean())
    gain, f, left = best_split(x, y - p, p * (1 - p))
    assert gain > 0 and trees.feature[0, 0] == f
    assert frozenset(np.flatnonzero(x[:, f] <= trees.threshold[0, 0])) == left
    # every node's value is the Newton step of the rows that reach it
    for node in np.flatnonzero(trees.feature[0] < 0):
        reach = []
        for i, row in enumerate(x):
            at = 0
            while trees.feature[0, at] >= 0:
                at = 2 * at + (2 if row[trees.feature[0, at]] > trees.threshold[0, at] else 1)
            if at == node:
                reach.append(i)
        if reach:
            step = (y - p)[reach].sum() / ((p * (1 - p))[reach].sum() + quality.SMOOTH)
            assert trees.value[0, node] == pytest.approx(step)


def test_boosting_lowers_the_loss(sample):
    x, y = sample
    trees = quality.grow(x, y)
    losses = []
    for k in range(0, quality.TREES + 1, 10):
        part = quality.Trees(
            trees.feature[:k], trees.threshold[:k], trees.value[:k], trees.start, trees.rate
        )
        p = part.score(x)
        losses.append(-np.mean(np.where(y > 0, np.log(p), np.log(1 - p))))
    assert losses == sorted(losses, reverse=True)
