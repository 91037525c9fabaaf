"""Reader and request cases that plain inputs do not show."""

import csv

from pyspark.sql import functions as F

from orrery.operators.metrics import FEATURE_GROUP_PATTERNS  # noqa: F401  (one rule table for both users)
from orrery.plans.score import normalized_window_start, validate_requests
from orrery.sources.telemetry import read_source
from orrery.specs import RAW_FIELDS


def test_csv_quotes_newlines_and_backslashes(spark, tmp_path):
    summaries = ['say ""hi"", x', "two\nlines", "c:\\", 'plain, "quoted"', ""]
    path = tmp_path / "odd.csv"
    with path.open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(RAW_FIELDS)
        for i, text in enumerate(summaries):
            out.writerow([text if name == "event_summary" else f"{name}{i}" for name in RAW_FIELDS])
    rows = read_source(spark, str(path)).orderBy("row_number").collect()
    assert [r.event_summary for r in rows] == summaries
    assert [r.row_number for r in rows] == [2, 3, 4, 5, 6]
    assert [r[RAW_FIELDS[-1]] for r in rows] == [f"{RAW_FIELDS[-1]}{i}" if RAW_FIELDS[-1] != "event_summary" else s for i, s in enumerate(summaries)]


def test_row_numbers_are_unique_over_a_directory(spark, tmp_path):
    path = str(tmp_path / "parts.parquet")
    spark.range(40).select(*[F.col("id").cast("string").alias(n) for n in RAW_FIELDS]).repartition(4).write.parquet(path)
    numbers = [r.row_number for r in read_source(spark, path).collect()]
    assert sorted(numbers) == list(range(2, 42))


REQUEST = "service_name string, host_id string, window_start string, window_minutes int, rolling_window_size int, observations array<struct<event_type:string>>"


def test_requests_need_keys_and_a_readable_time(spark):
    rows = [("a", "h", "2026-04-14T10:12:30+02:00", 5, 3, None), ("a", None, "2026-04-14T10:12:30", 5, 3, None),
            (" ", "h", "2026-04-14T10:12:30", 5, 3, None), ("a", "h", "not-a-time", 5, 3, None), ("a", "h", "2026-04-14T23:59:59Z", 60, 3, None)]
    checked = normalized_window_start(validate_requests(spark.createDataFrame(rows, REQUEST)))
    got = [(r.request_issue is None, r.window_start_normalized) for r in checked.select("request_issue", "window_start_normalized").collect()]
    assert [g[0] for g in got] == [True, False, False, False, True]
    assert got[0][1] == "2026-04-14T10:10:00+02:00" and got[3][1] is None and got[4][1] == "2026-04-14T23:00:00"
