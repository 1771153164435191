"""Rows are counted once although tasks fail and are repeated.

Needs a master that repeats failed tasks, so it runs in a process of its own.
"""

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(folder):
    from hearthline.sinks import write_table

    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    def fails_once(name):
        def check(x):
            marker = f"{folder}/{name}"
            if x % 1000 == 999 and not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError("once")
            return x

        return F.udf(check, "long")("id").alias("x")

    rows = spark.range(0, 10_000, 1, 4)
    cases = {
        "scan": (rows.select(fails_once("scan")), {}),
        "below": (rows.select(fails_once("below")), {"partitions": 3}),
        "above": (rows.repartition(3).select(fails_once("above")), {}),
    }
    for name, (df, how) in cases.items():
        counted = write_table(df, f"{folder}/{name}-table", **how)
        stored = spark.read.parquet(f"{folder}/{name}-table").count()
        print(name, counted, stored, os.path.exists(f"{folder}/{name}"))


def test_repeated_tasks_count_once(folder):
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, __file__, folder],
        env={**os.environ, "PYTHONPATH": str(root)},
        capture_output=True,
        text=True,
        timeout=300,
    )
    lines = [line.split() for line in done.stdout.splitlines()]
    for name in ("scan", "below", "above"):
        assert [name, "10000", "10000", "True"] in lines


if __name__ == "__main__":
    main(sys.argv[1])
