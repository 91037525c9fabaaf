"""CSV cut into many splits against Python's csv module."""

import csv
import random

from orrery.sources.telemetry import read_csv
from orrery.specs import RAW_FIELDS


def test_quoted_line_breaks_over_many_splits(spark, tmp_path):
    rng, rows = random.Random(4), {}
    odd = ['say "hi", x', "two\nlines", "c:\\", "", '"\n"\n"', "a\r\nb", "\n\n\n", "long " * 300 + "\n" + "more " * 300, "plain", 'quote at end"']
    for name in ("a.csv", "b.csv", "c.csv"):
        rows[name] = [[rng.choice(odd) if rng.random() < 0.3 else f"{name}{i}-{k}" for k in range(len(RAW_FIELDS))] for i in range(120)]
        with (tmp_path / name).open("w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator="\r\n" if name == "b.csv" else "\n")
            out.writerow(RAW_FIELDS)
            for i, row in enumerate(rows[name]):
                out.writerow(row)
                if i % 50 == 7:
                    f.write("\n")  # no record
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "4096")
    try:
        lines = read_csv(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        got = [[r[n] for n in (*RAW_FIELDS, "row_number")] for r in lines.orderBy("row_number").collect()]
    finally:
        spark.conf.set(name, before)
    want = [[*row, i + 2] for i, row in enumerate(r for n in sorted(rows) for r in rows[n])]
    assert got == want
