import glob

from recspark.plans import queries


def test_files_follow_the_rows(spark, sf_dir, monkeypatch):
    """Before, there were four files whatever the size; now as many as leave no task more than so many rows, in as many steps."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    folder, files = queries._in_files(spark, sf_dir, "events")
    assert files == 1 and len(glob.glob(f"{folder}/*.parquet")) == 4
    monkeypatch.setattr(queries, "_FILE_ROWS", rows // 10)
    folder, files = queries._in_files(spark, sf_dir, "events")
    assert files == 3 and len(glob.glob(f"{folder}/*.parquet")) == 12
    assert spark.read.parquet(folder).count() == rows
    assert queries._files(spark.range(0), 3) == 3
