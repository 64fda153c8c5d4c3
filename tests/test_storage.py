import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore import scratch
from areascore.partitions import spread
from areascore.sinks import write_csv, write_dataset, write_single_file, write_with_counts
from areascore.sources import Layout, read_csv, read_lookup_csv, read_population


def test_csv_quotes_breaks_and_bad_values(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        "skipped,TEXT COL,n,score\n"
        'x,"a ""quoted"" word, and\na second line",12.0,7\n'
        "y,plain,N/A,1e2\n"
        "z,,,\n"
    )
    df = read_csv(spark, str(path), {"TEXT COL": "string", "n": "int", "score": "double"})
    assert df.dtypes == [("TEXT COL", "string"), ("n", "int"), ("score", "double")]
    assert rows(df) == sorted(
        [('a "quoted" word, and\na second line', 12, 7.0), ("plain", None, 100.0), (None, None, None)], key=repr
    )
    assert "skipped" not in df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="absent"):
        read_csv(spark, str(path), {"absent": "string"})


def test_header_only_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("nta_code,population\n")
    assert read_csv(spark, str(path), {"population": "double"}).count() == 0
    assert read_population(spark, str(path)) is None
    assert read_population(spark, str(tmp_path / "absent.csv")) is None
    path.write_text("nta_code,nta_name,population\n0001,x,12\n0002,y,unknown\n")
    assert rows(read_population(spark, str(path))) == [("0001", 12.0), ("0002", None)]
    assert read_lookup_csv(spark, str(path)).first()["nta_code"] == "0001"


def test_layout():
    layout = Layout("hdfs://nn/user/me/", raw_root="hdfs://nn/user/me/data")
    assert layout.raw("a.csv") == "hdfs://nn/user/me/data/a.csv"
    assert layout.cleaned("crime") == "hdfs://nn/user/me/cleaned/crime"
    assert Layout("/d").raw("a.csv") == "/d/raw/a.csv"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_single_file_replaces(spark, tmp_path, fmt):
    path = str(tmp_path / f"out.{fmt}")
    df = spark.range(100).repartition(5)
    write_single_file(df.limit(3), path, fmt)
    write_single_file(df, path, fmt)
    assert os.path.isfile(path)
    back = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).csv(path)
    assert back.count() == 100
    assert not os.path.exists(path + ".parts")


def test_lookup_comes_back_as_written(spark, tmp_path):
    names = ['The "Hub", north', 'quote at end"', " padded ", "two\nlines", "plain"]
    df = spark.createDataFrame([(f"{i:05d}", name) for i, name in enumerate(names)], "zip string, name string")
    path = str(tmp_path / "lookup.csv")
    write_single_file(df, path, "csv")
    assert rows(read_lookup_csv(spark, path)) == rows(df)


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_with_other_headers_raise(spark, tmp_path, multi_line):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_text("id,lat,lon\n1,40.6,-73.8\n")
    (folder / "b.csv").write_text("id,lon,lat\n2,-73.8,40.6\n")
    columns = {"id": "string", "lat": "double", "lon": "double"}
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder), columns, multi_line).collect()
    write_csv(spark.createDataFrame([("1", 40.6, -73.8)], "id string, lat double, lon double").repartition(2), str(tmp_path / "same"))
    assert rows(read_csv(spark, str(tmp_path / "same"), columns, multi_line)) == [("1", 40.6, -73.8)]


def test_write_with_counts_and_parts(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(50).withColumn("v", F.when(F.col("id") % 2 == 0, F.col("id")))
    assert write_with_counts(df, path, hits=F.count("v")) == {"rows": 50, "hits": 25}
    write_dataset(df, path, parts=1)
    assert len([name for name in os.listdir(path) if name.endswith(".parquet")]) == 1
    assert spark.read.parquet(path).count() == 50


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark) == shared.rstrip("/")
    df = scratch.materialize(spark.range(5), "five")
    assert df.inputFiles()[0].removeprefix("file://").startswith(shared)
    assert df.count() == 5


def test_spread_only_moves_small_inputs(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    enough = spark.range(0, 100, 1, cores)
    assert spread(enough) is enough


def test_result_files_are_plain_json_types(spark, tmp_path):
    """Result tables hold only types that a browser reader understands."""
    from areascore.operators.summaries import metric_table
    from areascore.plans import civic

    path = str(tmp_path / "m.parquet")
    write_single_file(metric_table(spark, civic.METRICS), path)
    assert json.dumps([row.asDict() for row in spark.read.parquet(path).collect()])
