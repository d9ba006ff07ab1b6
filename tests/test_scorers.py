"""Models called once per Arrow batch."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwatch.operators import scoring


def two_models():
    """One gives a matrix of both classes, the other a map per row."""

    def ge_1(x):
        p = 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))
        return np.stack([1 - p, p], axis=1)

    def ge_2(x):
        return [{0: 1 - p, 1: p} for p in 1 / (1 + np.exp(-(0.5 * x[:, 0] - x[:, 1])))]

    return ge_1, ge_2


def test_classifier_outputs_score_batches(spark):
    rows = spark.range(500).select("id", F.array((F.col("id") % 7).cast("float"), (F.col("id") % 5).cast("float")).alias("features"))
    scored = scoring.BatchScorer(two_models).apply(rows.repartition(3)).collect()
    assert len(scored) == 500
    for r in scored:
        a, b = r.features
        assert r.p_ge_1 == pytest.approx(1 / (1 + np.exp(-(a - 0.5 * b))), abs=1e-6)
        assert r.p_ge_2 == pytest.approx(1 / (1 + np.exp(-(0.5 * a - b))), abs=1e-6)


def test_batch_scorer_accepts_empty_input(spark):
    from cellwatch.plans.batch_models import logistic_models

    rows = spark.range(0).select(F.array(F.lit(1.0).cast("float")).alias("features"))
    assert scoring.BatchScorer(logistic_models).apply(rows).collect() == []
