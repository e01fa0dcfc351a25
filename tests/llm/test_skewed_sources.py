"""Sources that need high rates still reach their target weights."""

import pytest

from tessera.llm import mixing


@pytest.mark.parametrize("small", [20, 1])
def test_target_weights_hold_at_high_rates(spark, small):
    rows = [(i, "x" * 100, "big") for i in range(2000 if small > 1 else 9000)] + [(20_000 + i, "y" * 10, "small") for i in range(small)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("big", 0.9), ("small", 0.1)], "source string, weight double")
    rate = {r["source"]: r["rate"] for r in mixing.rates(docs, weights).collect()}["small"]
    assert rate == pytest.approx(0.1 * sum(len(t) for _, t, _ in rows) / (10 * small), rel=1e-6) and rate > 16
    copies = mixing.mix(docs, weights).where("source = 'small'").count()
    assert abs(copies - rate * small) < 5 * (rate * small) ** 0.5
    assert mixing.mix(docs, weights, most=16.0).where("source = 'small'").count() < 30 * small
