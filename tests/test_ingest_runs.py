"""Ingest runs: repeated after a crash, equal names, equal content, unreadable lines, large files."""

from pyspark.sql import functions as F

from orrery.plans import jobs
from orrery.sources.files import file_checksums

HEADER = "timestamp,service_name,host_id,metric_name,metric_value,unit,event_type,event_summary,anomaly_label"


def row(second, value="60"):
    return f"2026-04-14T10:00:{second:02d}Z,edge-api,host-01,cpu_pct,{value},percent,metric,,normal"


def write(path, *rows):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([HEADER, *rows]), encoding="utf-8")
    return str(path)


def counts(report):
    return {r.path.split("/")[-2] + "/" + r.source_file: (r.status, r.total_rows_seen, r.rows_written, r.duplicate_rows)
            for r in report.collect()}


def test_runs_names_and_contents(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    a, b = write(tmp_path / "x" / "m.csv", row(1)), write(tmp_path / "y" / "m.csv", row(2), row(1))
    same = write(tmp_path / "z" / "copy.csv", row(1))
    want = {"x/m.csv": ("ingested", 1, 1, 0), "y/m.csv": ("ingested", 2, 1, 1), "z/copy.csv": ("skipped_existing_checksum", 0, 0, 0)}

    # the run dies after curated was written, then runs again under its id
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "validation_issues", lambda df: 1 / 0)
        try:
            jobs.ingest_job(spark, [a, b, same], out, run_id="007")
        except ZeroDivisionError:
            pass
    for _ in range(2):
        assert counts(jobs.ingest_job(spark, [a, b, same], out, run_id="007")) == want
    assert spark.read.parquet(f"{out}/curated").count() == 2
    assert spark.read.parquet(f"{out}/ingest_reports").count() == 3
    assert spark.read.parquet(f"{out}/bronze").count() == 3

    c = write(tmp_path / "x" / "n.csv", row(2), row(3))
    assert counts(jobs.ingest_job(spark, [a, c], out, run_id="8")) == {
        "x/m.csv": ("skipped_existing_checksum", 0, 0, 0), "x/n.csv": ("ingested", 2, 1, 1)}
    assert spark.read.parquet(f"{out}/curated").count() == 3


def test_unreadable_lines_are_kept_with_their_place(spark, tmp_path):
    path = tmp_path / "e.jsonl"
    good = ('{"timestamp": "2026-04-14T10:00:05Z", "service_name": "edge-api", "host_id": "host-01", "metric_name": "cpu_pct", '
            '"metric_value": 60, "unit": "percent", "event_type": "metric", "event_summary": "", "anomaly_label": "normal"}')
    path.write_text("\n".join([good, "{bad", good.replace(":05Z", ":06Z"), '"text"']), encoding="utf-8")
    out = str(tmp_path / "out")
    report = jobs.ingest_job(spark, [str(path)], out, run_id="q").first()
    assert (report.total_rows_seen, report.rows_written, report.rejected_rows) == (4, 2, 2)
    kept = spark.read.parquet(f"{out}/quarantine").orderBy("row_number").collect()
    assert [(r.source_file, r.row_number, r.corrupt_record) for r in kept] == [("e.jsonl", 3, "{bad"), ("e.jsonl", 5, '"text"')]


def test_large_files_are_known_by_place_and_time(spark, tmp_path):
    small, large = tmp_path / "s", tmp_path / "l"
    small.write_text("ab")
    large.write_text("abc" * 9)
    got = {r.length: r.checksum for r in file_checksums(spark, [str(small), str(large)], content_bytes=10).collect()}
    content = {r.length: r.checksum for r in file_checksums(spark, [str(small), str(large)]).collect()}
    assert got[2] == content[2] and got[27] != content[27]
    assert {r.length: r.checksum for r in file_checksums(spark, [str(large)], content_bytes=10).select(F.col("*")).collect()} == {27: got[27]}
