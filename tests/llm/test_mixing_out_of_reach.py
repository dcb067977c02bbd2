"""Targets out of reach: the step that counts."""

import numpy as np

from martcraft.llm import mixing as M


def test_first_step_near_the_least_residual():
    d = M.Descent(np.array([5.0, 5.0]), np.array([10.0, 0.0]), np.eye(2), M.MixRules())
    for y in ([7.5, 2.5], [9.4, 0.6], [9.3, 0.7], [9.5, 0.5]):  # 10 off at first, then 5, 1.2, 1.4 and 1
        d.next_step()
        d.take(np.array(y))
    assert len(d.fit().steps) == 4 and abs(d.fit().residual - 0.1) < 1e-9
    early = d.fit(0.25)
    assert len(early.steps) == 2 and abs(early.residual - 0.12) < 1e-9
