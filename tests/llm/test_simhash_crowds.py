"""op8's crowded signatures: their 2,016 signatures a member are never sent to the driver, and link the same fingerprints."""

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from shelfscope.llm import simhash  # noqa: E402
from shelfscope.llm.common import connected_components  # noqa: E402


def test_crowded_fingerprints_meet_in_one_aggregation(spark):
    rng = np.random.default_rng(8)
    low = int(rng.integers(0, 2**32))
    high = {int(x) for x in rng.integers(0, 2**32, 30)}
    fps = {low | h << 32 for h in high}
    for f in list(fps):
        for _ in range(3):
            i, j = (int(x) for x in rng.integers(0, 64, 2))
            fps |= {f ^ 1 << i, f ^ 1 << i ^ 1 << j, f ^ 1 << 63}
    fps = sorted(f - 2**64 if f >= 2**63 else f for f in fps)
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), crowd=4)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Join" in line and "rest" in line for line in plan), plan
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    edges = [(r["a"], r["b"]) for r in found.collect()]
    assert all(a < b and near(a, b) for a, b in edges)
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if near(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    got = {r["node"]: r["root"] for r in connected_components(found).collect()}
    assert {f: got.get(f, f) for f in fps} == {f: top(f) for f in fps}
