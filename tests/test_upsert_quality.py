import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbside.operators.quality import Check, QualityError, duplicates, require, run_checks
from kerbside.operators.upsert import incremental_slice, key_bucket, late_rows, publish, read_mart, upsert


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int")


def test_upsert_replaces_by_key_and_null_keys_pile_up(spark):
    stored, batch = frame(spark, ("a", 1), ("b", 2), (None, 3)), frame(spark, ("b", 20), ("b", 21), (None, 30))
    assert rows(upsert(stored, batch, "k")) == [("a", 1), ("b", 20), ("b", 21), (None, 3), (None, 30)]
    assert rows(upsert(None, batch, "k")) == rows(batch)


def test_upsert_keeps_both_column_sets(spark):
    wide = frame(spark, ("b", 2)).withColumn("extra", F.lit(1))
    assert rows(upsert(frame(spark, ("a", 1)), wide, "k"), "k", "v", "extra") == [("a", 1, None), ("b", 2, 1)]


def times(spark, *data):
    return spark.createDataFrame([(t,) for t in data], "t string").select(F.to_timestamp("t").alias("ts"))


def test_slice_and_late_rows(spark):
    target = times(spark, "2024-01-10 00:00:00", "2024-01-05 00:00:00")
    df = times(spark, "2024-01-08 23:59:59", "2024-01-09 00:00:00", "2024-02-01 00:00:00", None)
    assert incremental_slice(df, "ts", target, "ts").count() == 2
    assert late_rows(df, "ts", target, "ts").first().late_rows == 1
    assert incremental_slice(df, "ts", None, "ts").count() == 4
    assert incremental_slice(df, "ts", target.where("false"), "ts").count() == 4


def test_publish_rewrites_only_named_partitions(spark, tmp_path):
    mart = tmp_path / "mart"

    def run(name, *data, checks=()):
        publish(spark, frame(spark, *data), str(mart), str(tmp_path / name), "k", "bucket", key_bucket(F.col("k"), 8), checks)

    run("s1", *[(f"k{i}", i) for i in range(40)])
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in mart.iterdir() if p.is_dir()}
    run("s2", ("k1", 100), ("new", 7))
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in mart.iterdir() if p.is_dir()}
    touched = {f"bucket={r[0]}" for r in frame(spark, ("k1", 0), ("new", 0)).select(key_bucket(F.col("k"), 8)).distinct().collect()}
    assert {name for name in after if before.get(name) != after[name]} == touched
    got = dict(rows(read_mart(spark, str(mart)), "k", "v"))
    assert got["k1"] == 100 and got["new"] == 7 and got["k2"] == 2 and len(got) == 41
    with pytest.raises(QualityError, match="unique"):
        run("s3", ("x", 1), ("x", 2), checks=[Check("k", "unique")])
    assert len(rows(read_mart(spark, str(mart)))) == 41


def test_publish_keeps_columns_of_both_sides(spark, tmp_path):
    mart = str(tmp_path / "mart")

    def run(name, batch):
        publish(spark, batch, mart, str(tmp_path / name), "k", "bucket", F.lit(0))

    run("s1", frame(spark, ("a", 1), ("b", 2)).withColumn("extra", F.lit("x")))
    run("s2", frame(spark, ("b", 20)))
    run("s3", frame(spark, ("c", 3)).withColumn("new", F.lit(1.5)))
    got = rows(read_mart(spark, mart), "k", "v", "extra", "new")
    assert got == [("a", 1, "x", None), ("b", 20, None, None), ("c", 3, None, 1.5)]
    with pytest.raises(ValueError, match="column v: string in the batch, int in the mart"):
        run("s4", frame(spark, ("b", 2)).withColumn("v", F.col("v").cast("string")))
    assert rows(read_mart(spark, mart), "k", "v", "extra", "new") == got


def test_missing_mart_is_none(spark, tmp_path):
    assert read_mart(spark, str(tmp_path / "nothing")) is None


def test_checks(spark):
    df = frame(spark, ("a", 1), ("a", None), (None, 3), (None, 4))
    assert rows(duplicates(df, "k")) == [("a", 2)]
    report = run_checks(df, [Check("k", "unique"), Check("k", "not_null"), Check("v", "not_null"), Check("v", "unique")])
    assert rows(report) == [("k", "not_null", 2), ("k", "unique", 1), ("v", "not_null", 1), ("v", "unique", 0)]
    with pytest.raises(QualityError, match=r"not_null\(k\): 2"):
        require(df, [Check("k", "not_null")])
    require(df, [Check("v", "unique")])


def test_publish_stages_each_row_once(spark, tmp_path):
    mart = str(tmp_path / "mart")
    for number, data in enumerate(([("a", 1), ("b", 2)], [("b", 20), ("c", 3)])):
        publish(spark, frame(spark, *data), mart, str(tmp_path / f"s{number}"), "k", "bucket", F.lit(0), [Check("k", "unique")])
        staged = [r for part in (tmp_path / f"s{number}").iterdir() for r in rows(spark.read.parquet(str(part)), "k", "v")]
        assert sorted(staged) == ([("a", 1), ("b", 2)], [("a", 1), ("b", 20), ("c", 3)])[number] == rows(read_mart(spark, mart), "k", "v")
    with pytest.raises(QualityError, match="not_null"):
        publish(spark, frame(spark, ("d", None)), mart, str(tmp_path / "s2"), "k", "bucket", F.lit(0), [Check("v", "not_null")])
    assert rows(read_mart(spark, mart), "k", "v") == [("a", 1), ("b", 20), ("c", 3)]
