"""Plans of steps that large tables made slow: what is computed once, what is not shuffled, what HotSpot compiles."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from orrery.plans import score as SC
from orrery.plans import stages as S
from orrery.session import SESSION_CONF
from orrery.specs import METRIC_DEFAULTS
from orrery.streaming.store import Store

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def events(spark, path, n=40):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=25 * i), i % 3, ("click", "view", "purchase", "signup", "error")[i % 5], float(i * 7 % 31), f'{{"k": {i % 60}}}')
            for i in range(n)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(
        f"{path}/events.parquet")
    return str(path)


def test_queries_hold_generated_methods_to_what_is_compiled(spark, tmp_path):
    sf = events(spark, tmp_path)
    own = spark.newSession()
    own.conf.set(LIMIT, "65535")
    assert S.raw(own, sf).count() == 41
    assert own.conf.get(LIMIT) == SESSION_CONF[LIMIT] == "8000"
    own.conf.set(LIMIT, "4000")
    S.raw(own, sf)
    assert own.conf.get(LIMIT) == "4000"  # a lower limit of the caller stays


def requests(spark):
    metrics = ", ".join(f"{m}: double" for m in METRIC_DEFAULTS)
    entry = {m: 2.0 + i for i, m in enumerate(METRIC_DEFAULTS)}
    later = {m: 5.0 + i for i, m in enumerate(METRIC_DEFAULTS)}
    gaps = dict.fromkeys(METRIC_DEFAULTS)
    rows = [(60, 2, [{**entry, "event_count": 1}, {**later, "event_count": 0}], *([8.0] * len(METRIC_DEFAULTS)), 3),
            (60, 3, [{**gaps, "event_count": 1}], *([None] * len(METRIC_DEFAULTS)), 0), (60, 3, None, *([4.0] * len(METRIC_DEFAULTS)), 0)]
    return spark.createDataFrame(rows, f"window_minutes int, rolling_window_size int, history array<struct<{metrics}, event_count: int>>, "
                                       + ", ".join(f"_obs_{m} double" for m in METRIC_DEFAULTS) + ", _events long")


def test_request_features_compute_each_mean_and_deviation_once(spark):
    feats = SC.request_features(requests(spark))
    plan = feats._jdf.queryExecution().optimizedPlan()
    seen = sum(str(plan.p(i).expressions()).count("aggregate(") for i in range(100) if plan.p(i) is not None)
    assert 0 < seen <= 4 * len(METRIC_DEFAULTS)  # mean and deviation of the whole series and of its end
    first, empty, lone = feats.orderBy(F.desc("event_count"), F.desc("latency_ms_was_imputed")).collect()
    place = list(METRIC_DEFAULTS).index("latency_ms")
    series = [2.0 + place, 5.0 + place, 8.0]
    mean = sum(series) / 3
    std = (sum((x - mean) ** 2 for x in series) / 3) ** 0.5
    assert abs(first.latency_ms_zscore - (8.0 - mean) / std) < 1e-12
    assert (first.latency_ms_roll_mean, first.latency_ms_roll_min) == ((series[1] + 8.0) / 2, min(series[1:]))
    assert (empty.latency_ms, empty.latency_ms_zscore, empty.latency_ms_roll_std) == (METRIC_DEFAULTS["latency_ms"], 0.0, 0.0)
    assert (lone.latency_ms, lone.latency_ms_zscore) == (4.0, 0.0)


def test_rows_of_the_newest_batch_are_read_without_a_shuffle(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    columns = "service_name string, host_id string, window_start timestamp_ntz, event_count int"
    rows = [("s", "h", datetime(2024, 1, 1, h), h) for h in range(4)]
    store.write(spark.createDataFrame(rows, columns).withColumn("window_date", F.to_date("window_start")), "features", 0, "window_date")
    one = store.current(spark, "features")
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString() and one.count() == 4
    again = [("s", "h", datetime(2024, 1, 1, 2), 20), ("s", "h", datetime(2024, 1, 1, 4), 40)]
    store.write(spark.createDataFrame(again, columns).withColumn("window_date", F.to_date("window_start")), "features", 3, "window_date")
    assert sorted(r.event_count for r in store.current(spark, "features").collect()) == [0, 1, 3, 20, 40]
