"""Running totals over ranges, and the metrics built on them, against plain Python."""

import random

from orrery.operators.metrics import roc_auc, threshold_sweep
from orrery.operators.prefix import prefix_sums


def test_prefix_sums_of_a_large_and_of_small_groups(spark):
    rng, rows = random.Random(2), []
    for group, n in (("big", 3000), ("b", 5), ("c", 1), (None, 3)):
        rows += [(group, k, rng.randint(0, 9)) for k in rng.sample(range(10 ** 6), n)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(3)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        got = {(r.g, r.k): r.before for r in prefix_sums(df.where("g is not null"), ["g"], ["k"], {"v": "before"}).collect()}
    finally:
        spark.conf.set(name, "true")
    want = {}
    for group in ("big", "b", "c"):
        total = 0
        for _, k, v in sorted(r for r in rows if r[0] == group):
            want[group, k] = total
            total += v
    assert got == want


def test_auc_and_sweep_equal_plain_counting(spark):
    rng = random.Random(3)
    rows = [("m", rng.randint(0, 1), rng.randint(0, 20) / 20) for _ in range(400)] + [("one", 1, 0.5), ("one", 1, None), ("none", 0, None)]
    df = spark.createDataFrame(rows, "model_name string, label int, probability double")
    auc = {r.model_name: r.roc_auc for r in roc_auc(df).collect()}
    pos, neg = ([p for m, y, p in rows if m == "m" and y == side] for side in (1, 0))
    plain = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(auc["m"] - plain) < 1e-12 and auc["one"] is None
    for r in threshold_sweep(df).collect():
        own = [(y, p) for m, y, p in rows if m == r.model_name and p is not None]
        right = sum((p >= r.threshold) == (y == 1) for y, p in own)
        assert r.accuracy == (round(right / len(own), 6) if own else 0.0)
