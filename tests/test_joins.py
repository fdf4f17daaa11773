"""Joins whose sides both grow stay off the driver; models are fitted alike whatever part of a block they read."""

from types import SimpleNamespace

import numpy as np

from contestry.operators import fits, form
from contestry.sources.contests import stored_contests


def test_tables_that_grow_are_not_broadcast(spark):
    m = stored_contests(spark, "/root/testdata/sf0.001")
    plan = form.feature_table(m)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_a_boosted_step_reads_neither_inputs_nor_ids():
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, fits.BINS, (300, 4)).astype(np.uint8), rng.integers(0, 3, 300).astype(np.int8)
    tree = [1, 9.0, 0, 20.0, 2, fits.NO_SPLIT, 0.1, -0.2, 0.3, 0.4]
    row = SimpleNamespace(y=y.tobytes(), bins=bins.tobytes(), weights=tree, pending=[3, 4.0, 0, fits.NO_SPLIT, 2, 15.0], counts=[1.0, 1.0, 1.0])
    block = fits.Block(row)
    p = fits.softmax(np.array([[[0.1, -0.2, 0.3, 0.4][(2 + (b[2] > fits.NO_SPLIT)) if b[1] > 9 else int(b[0] > 20)], 0, 0] for b in bins]))
    expected = np.zeros((3, 2, 2, 4, fits.BINS))
    for i, b in enumerate(bins):
        for c, (f, edge) in enumerate(((3, 4), (0, fits.NO_SPLIT), (2, 15))):
            for j in range(4):
                expected[c, 0, int(b[f] > edge), j, b[j]] += p[i, c] - (y[i] == c)
                expected[c, 1, int(b[f] > edge), j, b[j]] += 2 * p[i, c] * (1 - p[i, c])
    assert np.allclose(fits.histogram_sums(block), expected.ravel())
