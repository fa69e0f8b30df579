import numpy as np
import pytest
from pyspark.sql import functions as F

from textgrain.operators import models, narrow
from textgrain.operators.hinge import GAP


def cloud(spark, n, noise):
    source = np.random.default_rng(3)
    x = source.normal(size=(n, 6)) * np.arange(1, 7)
    label = (x[:, 0] + noise * source.normal(size=n) > -0.8).astype(int)
    rows = [(i, int(t), v.tolist()) for i, (t, v) in enumerate(zip(label, x))]
    return x, np.where(label == 1, 1.0, -1.0), spark.createDataFrame(rows, "doc_id long, label int, vec array<double>")


@pytest.mark.parametrize(("c", "noise"), [(1e-4, 1.0), (1.0, 1.0), (10.0, 3.0), (1.0, 0.0)])
def test_looks_at_all_rows_reach_their_certificate(spark, c, noise):
    x, y, df = cloud(spark, 900, noise)
    weights, primal, dual = narrow.fitted_dense(df.repartition(5).cache(), 6, c)
    value = c * np.maximum(0.0, 1.0 - y * (x @ weights[:-1] + weights[-1])).sum() + 0.5 * weights @ weights
    assert value == pytest.approx(primal, rel=1e-9)
    assert dual <= primal * (1 + 1e-9) and primal - dual <= GAP * primal


def test_a_dense_fit_of_several_blocks_agrees_with_one_block(spark, monkeypatch):
    _, _, df = cloud(spark, 900, 1.0)
    df = df.withColumn("vec", F.when(F.col("doc_id") > 0, F.col("vec")).otherwise(F.array(*[F.lit(0.5)] * 6)))
    one, looks, real = models.fit_dense(df), [], narrow.look
    monkeypatch.setattr(narrow, "look", lambda *a: looks.append(a) or real(*a))
    monkeypatch.setattr(models, "BLOCK_ROWS", 300)
    many = models.fit_dense(df)
    # More blocks than one, and no rounds of blocks: a few dozen looks.
    assert 0 < len(looks) < 60
    assert many.primal == pytest.approx(one.primal, rel=2 * GAP)
    assert np.allclose(many.weights, one.weights, atol=0.05 * np.abs(one.weights).max())
