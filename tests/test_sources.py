import datetime

import pytest
from pyspark.errors import AnalysisException

from lendmart import schemas
from lendmart.sources import snapshots as S


def slice_of(spark, day, values):
    return spark.createDataFrame([(v, datetime.date(2024, day, 1)) for v in values],
                                 "v int, snapshot_date date")


def rows(spark, path):
    return sorted((r["v"], str(r["snapshot_date"])) for r in spark.read.parquet(path).collect())


def test_replace_is_idempotent_and_order_independent(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    first, second = slice_of(spark, 1, [1, 2]), slice_of(spark, 2, [3])
    for df in (first, second, first, second):
        S.write_slices(df, a)
    for df in (second, first):
        S.write_slices(df, b)
    assert rows(spark, a) == rows(spark, b) == [
        (1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-02-01")]
    S.write_slices(slice_of(spark, 1, [9]), a)
    assert rows(spark, a) == [(3, "2024-02-01"), (9, "2024-01-01")]


def test_skip_leaves_a_loaded_slice_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not S.is_loaded(spark, path, "2024-01-01")
    assert S.write_slices(slice_of(spark, 1, [1]), path, mode="skip", value="2024-01-01")
    assert S.is_loaded(spark, path, "2024-01-01")
    assert not S.write_slices(slice_of(spark, 1, [7]), path, mode="skip", value="2024-01-01")
    assert not S.is_loaded(spark, path, "2024-02-01")
    assert rows(spark, path) == [(1, "2024-01-01")]
    with pytest.raises(ValueError):
        S.write_slices(slice_of(spark, 1, [7]), path, mode="append")


def test_read_snapshot_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_slices(slice_of(spark, 1, [1]).unionByName(slice_of(spark, 2, [2])), path)
    df = S.read_snapshot(spark, path, "2024-02-01", columns=["v"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert [r["v"] for r in df.collect()] == [2]
    assert S.read_snapshot(spark, path, "2024-03-01").isEmpty()


def test_upsert_keeps_history_when_columns_differ(spark):
    old = slice_of(spark, 1, [1]).unionByName(slice_of(spark, 2, [2]))
    new = slice_of(spark, 2, [5]).selectExpr("*", "'x' AS extra")
    out = S.upsert_slice(old, new, "2024-02-01")
    assert sorted((r["v"], r["extra"]) for r in out.collect()) == [(1, None), (5, "x")]
    again = S.upsert_slice(out, new, "2024-02-01")
    assert again.exceptAll(out).isEmpty() and out.exceptAll(again).isEmpty()


def test_csv_with_doubled_quotes_is_read_by_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('Name,Customer_ID,Age,SSN,Occupation,snapshot_date\n'
                    '"Ann ""A"" Lee, jr",c1,24_,x,Doctor,2024-01-01\n')
    row = S.read_csv(spark, str(path), schemas.ATTRIBUTES_RAW).first()
    assert row["Name"] == 'Ann "A" Lee, jr' and row["Age"] == "24_"
    assert row["snapshot_date"] == datetime.date(2024, 1, 1)
    path.write_text("Customer_ID\nc1\n")
    with pytest.raises(AnalysisException):
        S.read_csv(spark, str(path), schemas.ATTRIBUTES_RAW)


def test_stage_folder_is_the_cluster_s_where_it_names_one():
    class Context:
        applicationId = "app-1"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        def __init__(self, named):
            self.conf = {"spark.checkpoint.dir": named} if named else {}

    assert S.checkpoint_folder(Session("s3a://shared/x")) == "s3a://shared/x"
    own = S.checkpoint_folder(Session(None))
    assert own == S.checkpoint_folder(Session(None)) and "lendmart-" in own


def test_replace_of_a_slice_clears_what_the_frame_no_longer_has(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in (1, 2):
        S.write_slices(slice_of(spark, day, [day]), path, value=f"2024-0{day}-01")
    S.write_slices(slice_of(spark, 1, [5]).filter("v < 0"), path, value="2024-01-01")
    assert rows(spark, path) == [(2, "2024-02-01")]
    by = ["snapshot_date", "model"]
    two = slice_of(spark, 1, [1, 2]).selectExpr("*", "concat('m', v) AS model")
    S.write_slices(two, path + "2", by, value="2024-01-01")
    S.write_slices(two.filter("v = 2"), path + "2", by, value="2024-01-01")
    assert [r["model"] for r in spark.read.parquet(path + "2").collect()] == ["m2"]
