"""The learner against follow-the-regularised-leader written out for one coordinate at a time."""

import math
import random

import numpy as np

from matnworks.llm import classifier


def test_leader_equals_plain_updates():
    r = random.Random(3)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= classifier.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * classifier.L1) / ((classifier.BETA + math.sqrt(n[i])) / classifier.ALPHA + classifier.L2)

    leader = classifier.Leader()
    for _ in range(400):
        at = r.sample(range(30), r.randrange(1, 6)) + [1 << classifier.BITS]
        values = [r.random() for _ in at[:-1]] + [1.0]
        label = int(7 in at or r.random() < 0.3)
        before = {i: weight(i) for i in at}
        chance = 1 / (1 + math.exp(-sum(before[i] * x for i, x in zip(at, values, strict=True))))
        for i, x in zip(at, values, strict=True):
            slope = (chance - label) * x
            change = (math.sqrt(n.get(i, 0.0) + slope**2) - math.sqrt(n.get(i, 0.0))) / classifier.ALPHA
            z[i] = z.get(i, 0.0) + slope - change * before[i]
            n[i] = n.get(i, 0.0) + slope**2
        leader.learn(np.array(at), np.array(values), label)
    used = sorted(z)
    assert np.allclose(leader.weights(np.array(used)), [weight(i) for i in used], rtol=1e-9, atol=1e-12)
    assert np.count_nonzero(leader.weights(slice(None))) == sum(weight(i) != 0 for i in used) > 10
