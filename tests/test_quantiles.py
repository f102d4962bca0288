import random

import numpy as np
import pytest

from tidewire.operators.quantiles import grouped_percentile


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_percentiles_equal_numpy(spark, share):
    rng = random.Random(5)
    rows = [("hot", rng.random()) for _ in range(4000)]
    rows += [(f"g{i}", v) for i in range(30) for v in ([rng.choice([0.1, 0.5, 0.9, -3.0, 7.5]) for _ in range(rng.randint(1, 9))] + [None])]
    rows += [(None, 0.25), (None, 0.75), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["p"] for r in grouped_percentile(df, ["k"], "v", share, "p", bins=16).collect()}
    want = {k: np.percentile([v for a, v in rows if a == k and v is not None], share * 100) for k in {a for a, v in rows if v is not None}}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert grouped_percentile(df.limit(0), ["k"], "v", share, "p").count() == 0
