"""The slope test of the joint likelihood beside the estimate over the grid."""

import numpy as np

from quillframe.llm import nearcopies


def test_slope_agrees_with_the_grid():
    r = np.random.default_rng(1)
    seen = set()
    for _ in range(3000):
        n, m = r.integers(50, 5000), 0
        m = int(n * r.uniform(0.86, 1.16))
        if min(n, m) < 0.85 * max(n, m):
            continue
        at = r.uniform(0.3, 0.84)
        shares = r.dirichlet([2, 2, r.uniform(1, 40)])
        more, less = (int(s * nearcopies.REGISTERS) for s in shares[:2])
        x = np.zeros(nearcopies.REGISTERS, "<u2") + 5
        y = x.copy()
        y[:more] -= 1
        y[more:more + less] += 1
        found = nearcopies.estimate(x.tobytes(), y.tobytes(), n, m)
        if abs(found - at) < 0.01:  # the grid is not finer
            continue
        got = bool(nearcopies.likely(np.array([more]), np.array([less]), n, np.array([m]), at)[0])
        assert got == (found > at)
        seen.add(got)
    assert seen == {True, False}
