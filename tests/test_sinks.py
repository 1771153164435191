from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hearthline.sinks import shared_folder, stage, staging, unstage, write_table


@pytest.fixture
def banded(spark):
    band = F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "small").otherwise("2")
    return spark.range(0, 1000, 1, 5).select(F.col("id"), band.alias("band"))


def files(path, pattern="part-*.parquet"):
    return list(Path(path).rglob(pattern))


@pytest.mark.parametrize("how", [{}, {"rebalance": True}, {"rebalance": False}, {"partitions": 3}])
@pytest.mark.parametrize("partition_by", [None, "band"])
def test_rows_are_counted_and_read_back(spark, folder, banded, how, partition_by):
    path = f"{folder}/t"
    assert write_table(banded, path, partition_by=partition_by, **how) == 1000
    back = spark.read.schema(banded.schema).parquet(path)
    assert sorted(back.collect()) == sorted(banded.collect())
    if partition_by:
        assert {p.name for p in Path(path).glob("band=*")} == {"band=big", "band=small", "band=2"}
        assert spark.read.schema(banded.schema).parquet(path).filter("band = '2'").count() == 100


def test_file_counts(folder, banded):
    write_table(banded, f"{folder}/own")
    assert len(files(f"{folder}/own")) == 5
    write_table(banded, f"{folder}/three", partitions=3)
    assert len(files(f"{folder}/three")) == 3
    many = banded.repartition(40)
    write_table(many, f"{folder}/even", partition_by="band")
    assert len(files(f"{folder}/even")) == 3
    write_table(many, f"{folder}/uneven", partition_by="band", rebalance=False)
    assert len(files(f"{folder}/uneven")) > 40


def test_overwrite_replaces_the_whole_table(spark, folder, banded):
    path = f"{folder}/t"
    write_table(banded, path, partition_by="band")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert write_table(banded.filter("band = 'big'"), path, partition_by="band") == 700
        assert [p.name for p in Path(path).glob("band=*")] == ["band=big"]
        assert write_table(banded.filter("band = 'big'"), path, partition_by="band") == 700
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(path).count() == 700


def test_empty_table_is_written_and_counted(spark, folder, banded):
    path = f"{folder}/t"
    assert write_table(banded.filter("id < 0"), path) == 0
    assert write_table(spark.createDataFrame([], banded.schema), f"{folder}/u") == 0
    assert spark.read.parquet(path).count() == 0


def test_rows_of_a_sorted_aggregate_are_counted(banded, folder):
    counted = banded.groupBy("band").count().orderBy("band")
    assert write_table(counted, f"{folder}/t", partitions=2) == 3


def test_stage_uses_the_shared_folder(spark, banded):
    before = set(Path(shared_folder(spark).removeprefix("file:")).glob("bands-*"))
    staged = stage(banded, "bands")
    assert staged.rows == 1000 and sorted(staged.table.collect()) == sorted(banded.collect())
    after = set(Path(shared_folder(spark).removeprefix("file:")).glob("bands-*"))
    assert len(after - before) == 1
    assert staged.table.dtypes == banded.dtypes
    unstage(spark, staged.path)
    assert not Path(staged.path.removeprefix("file:")).exists()
    assert before <= set(Path(shared_folder(spark).removeprefix("file:")).glob("bands-*"))


class Session:
    """A session as seen by ``shared_folder``."""

    def __init__(self, master, configured=None, current=None):
        self.sparkContext = self
        self.conf = self
        self.master, self.configured, self.current = master, configured, current

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.configured or default

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


def test_shared_folder_is_the_configured_one():
    assert shared_folder(Session("spark://x", "s3://shared")) == "s3://shared"
    assert shared_folder(Session("spark://x", None, "hdfs://set")) == "hdfs://set"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://x"))
    local = Session("local[2]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(local)
    assert local.current is None


def test_staging_deletes_its_files(spark, banded):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    with staging(spark) as stage_here:
        table = stage_here(banded, "here").table
        assert table.count() == 1000 and list(shared.glob("here-*"))
    assert not list(shared.glob("here-*"))
    with pytest.raises(Exception), staging(spark) as stage_here:
        stage_here(banded.select(F.raise_error(F.lit("no"))), "here")
    assert not list(shared.glob("here-*"))
