"""FeatureCollection documents read by byte ranges: against a JSON parser, at every size of range."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore.sources import read_features
from areascore.sources.feature_collections import read_feature_texts

AWKWARD = ["plain", "} {", '"', '\\"}', "\\", "\\\\", 'a "{" b', "é}", "[{", "", '"features": [{', "tab\t\n"]


def feature(i, draw):
    ring = [[i, i], [i + 1, i], [i, i + 0.5], [i, i]]
    kind, coordinates = draw.choice([("Polygon", [ring] * draw.randint(1, 3)), ("MultiPolygon", [[ring]]), ("Point", [i, 0.5])])
    properties = {"nta_code": f"A{i}", "nta_name": draw.choice(AWKWARD) + draw.choice(AWKWARD), draw.choice(AWKWARD) or "k": {"x": {"y": i}}}
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


def document(n, seed, indent=None, ascii_only=True):
    draw = random.Random(seed)
    root = {"type": "FeatureCollection", "name": draw.choice(AWKWARD), "crs": {"type": "name", "properties": {"n": "}"}}}
    root |= {"list": [{"z": 1}, {"z": {"y": 2}}], "features": [feature(i, draw) for i in range(n)], "after": [{"b": 1}], "end": {"c": "]"}}
    return json.dumps(root, indent=indent, ensure_ascii=ascii_only), root["features"]


@pytest.fixture
def ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}

    def put(n):
        for k, v in zip(keys, (n, 0, 1), strict=True):
            spark.conf.set(k, str(v))

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("size", [64, 700, 10**6])
@pytest.mark.parametrize("indent,ascii_only", [(None, True), (2, False)])
def test_every_size_of_range(spark, tmp_path, ranges, size, indent, ascii_only):
    text, features = document(40, size, indent, ascii_only)
    path = tmp_path / "areas.json"
    path.write_text(text)
    ranges(size)
    got = sorted(((r.ord, json.loads(r.feature)) for r in read_feature_texts(spark, str(path)).collect()), key=lambda r: r[0])
    assert got == list(enumerate(features))


def test_features_are_those_of_the_whole_document(spark, tmp_path, ranges):
    for i, n in enumerate((0, 1, 25)):
        (tmp_path / f"{i}.json").write_text(document(n, i)[0])
    ranges(500)
    split, whole = (
        rows(read_features(spark, str(tmp_path), split=s).withColumn("coordinates", F.replace("coordinates", F.lit(" "), F.lit(""))))
        for s in (True, False)
    )
    assert len(split) == 26 and split == whole


def test_no_value_is_longer_than_a_feature(spark, tmp_path, ranges):
    text, features = document(400, 3)
    path = tmp_path / "areas.json"
    path.write_text(text)
    ranges(len(text) // 12)
    got = read_feature_texts(spark, str(path))
    assert got.count() == 400
    longest = max(len(json.dumps(f)) for f in features)
    assert got.selectExpr("max(length(feature))").first()[0] <= longest
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() >= 12


def test_documents_without_features(spark, tmp_path):
    for i, text in enumerate(['{"type": "FeatureCollection", "features": []}', "{}", "", '{"other": [{"a": 1}], "x": {"features": [{"b": 1}]}}']):
        (tmp_path / f"{i}.json").write_text(text)
    assert read_feature_texts(spark, str(tmp_path)).count() == 0
