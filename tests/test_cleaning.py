from conftest import rows
from pyspark.sql import functions as F

from areascore.operators import cleaning, lookup, reshape


def test_clean_events(spark):
    raw = spark.createDataFrame(
        [
            (" felony ", " bronx ", 1.0),
            (None, "BRONX", 2.0),
            ("x", "(null)", 3.0),
            ("x", "   ", 4.0),
            ("x", None, 5.0),
            ("x", "queens", None),
        ],
        "`law cat` string, boro string, lat double",
    )
    spec = cleaning.CleanSpec(
        columns={"law cat": "law", "boro": "boro", "lat": "lat"},
        required=["boro", "lat"],
        upper=["law", "boro"],
        sentinels={"boro": ["(NULL)", ""]},
        flags={"is_felony": F.col("law") == "FELONY"},
    )
    assert rows(cleaning.clean_events(raw, spec)) == [
        ("FELONY", "BRONX", 1.0, 1),
        (None, "BRONX", 2.0, 0),
    ]


def test_sentinel_null_always_drops(spark):
    df = spark.createDataFrame([("A",), ("",), (None,), ("UNSPECIFIED",)], "boro string")
    assert rows(cleaning.drop_sentinels(df, {"boro": ["UNSPECIFIED"]})) == [("",), ("A",)]


def test_region_filter_and_measure_names(spark):
    df = spark.createDataFrame(
        [("New York", "x"), ("Yonkers", "the NEW york area"), ("Boston", "b"), ("Boston", None), (None, "b")],
        "City string, Metro string",
    )
    kept = cleaning.keep_region(df, "City", "New York", ["Metro", "MsaName"], "new york")
    assert rows(kept.select("City")) == [("New York",), ("Yonkers",)]
    with_msa = df.withColumn("MsaName", F.lit("New York"))
    assert cleaning.keep_region(with_msa, "City", "New York", ["MsaName"], "new york").count() == 5
    names = spark.createDataFrame([(1, 2, 3, 4)], "`2020-01-31` int, `202` int, `20x0` int, City int")
    assert cleaning.measure_columns(names) == ["2020-01-31"]


def test_melt_mixed_types_and_latest(spark):
    df = spark.createDataFrame(
        [("07030", "1", None, "x"), ("10001", None, None, "2.5"), ("10002", None, None, None)],
        "zip string, `2020-01-31` string, `2020-02-29` string, `2020-03-31` string",
    )
    long = reshape.melt(df, ["zip"], cleaning.measure_columns(df), "month", "value")
    assert rows(long) == [("07030", "2020-01-31", 1.0), ("10001", "2020-03-31", 2.5)]
    several = spark.createDataFrame(
        [("a", "2020-01", 5.0, "p"), ("a", "2020-03", 1.0, "q"), ("b", "2019-12", 2.0, "r")],
        "k string, month string, v double, tag string",
    )
    latest = reshape.latest_per_key(several, ["k"], "month")
    assert latest.columns == several.columns[:1] + ["month", "v", "tag"]
    assert rows(latest) == [("a", "2020-03", 1.0, "q"), ("b", "2019-12", 2.0, "r")]


def test_modal_lookup_ties_and_distinct(spark):
    df = spark.createDataFrame(
        [("z1", "B", "b", 1), ("z1", "A", "a", 2), ("z2", "A", "a", 3), ("z2", "B", "b", 4), ("z2", "B", "b", 4)],
        "zip string, code string, name string, venue int",
    )
    assert rows(lookup.modal_lookup(df, "zip", ["code", "name"])) == [
        ("z1", "A", "a"),
        ("z2", "B", "b"),
    ]
    assert rows(lookup.modal_lookup(df, "zip", ["code", "name"], distinct="venue")) == [
        ("z1", "A", "a"),
        ("z2", "A", "a"),
    ]


def test_hit_rate_of_nothing(spark):
    empty = spark.createDataFrame([], "code string")
    assert rows(lookup.hit_rate(empty, "code")) == [(0, 0, 0.0)]


def test_row_wise_cleaning_accepts_a_stream(spark, tmp_path):
    """Nothing in the cleaning stage runs an action, so it also takes a streaming source."""
    source = str(tmp_path / "in")
    spark.createDataFrame([(" bronx ", 30), ("0", 1), ("QUEENS", 5)], "boro string, score int").write.parquet(source)
    stream = spark.readStream.schema("boro string, score int").parquet(source)
    spec = cleaning.CleanSpec(
        columns={"boro": "boro", "score": "score"},
        required=["boro"],
        upper=["boro"],
        sentinels={"boro": ["0", ""]},
        flags={"is_critical": F.col("score") >= 28},
    )
    out = str(tmp_path / "out")
    query = (
        cleaning.clean_events(stream, spec)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(out)) == [("BRONX", 30, 1), ("QUEENS", 5, 0)]
