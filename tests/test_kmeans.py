"""k-means on blocks finds what Spark ML finds, whatever the blocks and however often rows repeat."""

import numpy as np
from pyspark.ml.clustering import KMeans

from orrery.ml import kmeans as K
from orrery.ml import train as TR


def table(spark, n=900, copies=1):
    rng = np.random.default_rng(2)
    middle = np.array([[0.0, 0.0], [9.0, 1.0], [2.0, 8.0]])
    x = (middle[np.arange(n) % 3] + rng.normal(size=(n, 2))).round(2)
    rows = [tuple(map(float, r)) for r in x] * copies
    return TR.assembler(["a", "b"]).transform(spark.createDataFrame(rows, "a double, b double").repartition(3)), np.array(rows)


def test_centers_and_cost_are_those_of_spark_ml(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 100)
    df, rows = table(spark)
    df = df.repartition(9)  # more partitions than tasks
    theirs, k = TR.fit_kmeans(df, restarts=4)
    ours, same_k = TR.fit_kmeans(df, restarts=4, spark_ml_rows=0)
    order = lambda m: np.array(sorted(c.tolist() for c in m.clusterCenters()))
    assert k == same_k == 3 and type(ours) is type(theirs) and np.allclose(order(ours), order(theirs), atol=1e-6)
    assert [r.n for r in ours.transform(df).groupBy("prediction").agg({"*": "count"}).toDF("p", "n").orderBy("n").collect()] == \
        [r.n for r in theirs.transform(df).groupBy("prediction").agg({"*": "count"}).toDF("p", "n").orderBy("n").collect()]
    again, _ = TR.fit_kmeans(df, restarts=4, spark_ml_rows=0)
    assert np.array_equal(order(again), order(ours))


def test_equal_rows_are_one_row_with_their_number(spark):
    df, rows = table(spark, n=300, copies=5)
    block, = K.points_of(df.coalesce(1), 1).collect()
    assert block.rows.sum() == 1500 and len(block.x) <= 300
    ours, _ = TR.fit_kmeans(df, restarts=3, spark_ml_rows=0)
    centers = np.array([c.tolist() for c in ours.clusterCenters()])
    own = K.costs(rows, centers).argmin(axis=1)
    assert np.allclose(centers, [rows[own == i].mean(axis=0) for i in range(3)], atol=1e-4)


def test_fewer_distinct_rows_than_clusters(spark):
    df = TR.assembler(["a", "b"]).transform(spark.createDataFrame([(1.0, 2.0)] * 6 + [(3.0, 4.0)] * 2, "a double, b double"))
    model, k = TR.fit_kmeans(df, restarts=2, spark_ml_rows=0)
    assert k == 3 and sorted(c.tolist() for c in model.clusterCenters()) == [[1.0, 2.0], [3.0, 4.0]]
    assert isinstance(KMeans(k=3).fit(df), type(model))
