"""CSV read by byte ranges: against a plain parser, at every size of range."""

import csv
import io
import random

import pytest
from conftest import rows

from areascore.sources import inferred_types, misfits, read_csv, read_inferred_csv
from areascore.sources.csv_records import read_records


@pytest.fixture
def ranges(spark):
    """Sets the bytes of a range; what is smaller than a record is allowed as well."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}

    def put(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def feed(n, seed=1):
    draw = random.Random(seed)
    parts = ["plain", "a,b", 'say ""x""'.replace('""', '"'), "two\nlines", "\n\n", '"', '",\n"', "é\r\nü", "long " * 30 + "\n" + "end"]
    return [[str(i), draw.choice(parts) + draw.choice(parts), draw.choice(["", "x", "1.5"])] for i in range(n)]


def text_of(records, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["id", "note", "last"], *records])
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [37, 256, 5_000, 10**6])
def test_every_size_of_range(spark, tmp_path, ranges, size, end):
    records = feed(120)
    path = tmp_path / "feed.csv"
    path.write_bytes(text_of(records, end).encode())
    ranges(size)
    got = rows(read_csv(spark, str(path), split=True))
    assert got == sorted(((a, b, c or None) for a, b, c in records), key=repr)


def test_many_files_each_with_its_own_header(spark, tmp_path, ranges):
    every = []
    for i in range(4):
        records = feed(30, i)
        every += records
        (tmp_path / f"{i}.csv").write_bytes(text_of(records).encode())
    (tmp_path / "empty.csv").write_bytes(b"id,note,last\n")
    ranges(300)
    assert rows(read_csv(spark, str(tmp_path), split=True)) == sorted(((a, b, c or None) for a, b, c in every), key=repr)


def test_as_many_tasks_as_ranges(spark, tmp_path, ranges):
    path = tmp_path / "feed.csv"
    path.write_bytes(text_of(feed(3000)).encode())
    ranges(path.stat().st_size // 16)
    records = read_records(spark, str(path))
    assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() >= 16
    assert records.count() == 3001 and records.filter("is_first").count() == 1
    largest = max(r["count"] for r in records.groupBy("file").count().collect())
    assert largest == 3001
    whole = read_csv(spark, str(path), split=False)
    assert whole.rdd.getNumPartitions() == 1
    assert rows(read_csv(spark, str(path), split=True)) == rows(whole)


def test_wrong_files_raise(spark, tmp_path):
    cases = {
        "unclosed": 'id,note\n1,"open\n2,x\n',
        "stray": 'id,note\n1,5" pipe\n2,6" pipe\n',
    }
    for name, text in cases.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        with pytest.raises(Exception, match="quote"):
            read_csv(spark, str(path), split=True).collect()
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("id,note\n1,x\n")
    (folder / "b.csv").write_text("note,id\nx,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(folder), split=True).collect()


def test_stray_quotes_in_one_line_are_text(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text('id,note\n1,5" and 6" pipes\n\n2,"x\ny"\n')
    got = rows(read_csv(spark, str(path), split=True))
    assert got == [("1", '5" and 6" pipes'), ("2", "x\ny")]


def test_large_files_are_split_by_themselves(spark, tmp_path, monkeypatch):
    from areascore.sources import readers

    path = tmp_path / "feed.csv"
    path.write_bytes(text_of(feed(500)).encode())
    whole = rows(read_csv(spark, str(path), {"id": "int", "note": "string"}))
    seen = []
    monkeypatch.setattr(readers, "SPLIT_BYTES", 1000)
    monkeypatch.setattr(readers, "read_records", lambda *a: seen.append(a) or read_records(*a))
    assert rows(read_csv(spark, str(path), {"id": "int", "note": "string"})) == whole
    assert len(seen) == 1
    read_csv(spark, str(path), multi_line=False)
    assert len(seen) == 1


VALUES = {
    "int": ["1", "-2147483648", "+7", " 12 ", "007"],
    "bigint": ["2147483648", "-9223372036854775808", "1"],
    "double": ["1.5", "-.5", "2.", "1e10", "9223372036854775808", "3"],
    "timestamp": ["2020-01-01", "2020-02-29 23:59:59", "2020-02-29T01:02", "2020-01-01 00:00:00.123456"],
    "string": ["1", "x"],
    "both": ["1", "2020-01-01"],
    "none": ["", None, "  "],
    "nan": ["NaN", "1"],
    "no_day": ["2021-02-30"],
    "huge": ["9" * 39, "1"],
    "hex": ["0x1F", "1"],
}
WANTED = {"huge": "double", "both": "string", "none": "string", "nan": "string", "no_day": "string", "hex": "string"}


def test_lattice_of_types(spark):
    for name, values in VALUES.items():
        df = spark.createDataFrame([(v,) for v in values], "v string")
        assert inferred_types(df).first()["type"] == WANTED.get(name, name), name


def test_counts_of_parts_add_up(spark):
    values = [v for group in VALUES.values() for v in group]
    whole = spark.createDataFrame([(v,) for v in values], "v string")
    counts = [inferred_types(whole.limit(0).unionAll(spark.createDataFrame([(v,) for v in part], "v string"))).first() for part in (values[:20], values[20:])]
    total = inferred_types(whole).first()
    assert all(total[c] == counts[0][c] + counts[1][c] for c in ("n", "n_null", "n_int", "n_bigint", "n_double", "n_timestamp"))


def test_tolerance_and_misfits(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("a,b\n" + "".join(f"{i},{'x' if i == 3 else i * 0.5}\n" for i in range(50)))
    strict = dict(read_inferred_csv(spark, str(path)).dtypes)
    loose = read_inferred_csv(spark, str(path), tolerance=0.05)
    assert strict == {"a": "int", "b": "string"} and dict(loose.dtypes) == {"a": "int", "b": "double"}
    assert [r.a for r in loose.filter("b is null").collect()] == [3]
    text = read_csv(spark, str(path))
    assert rows(misfits(text, {"a": "double", "b": "int"})) == [("a", "double", 50, 0), ("b", "int", 50, 50)]
    assert inferred_types(text.limit(0)).count() == 0


def test_no_task_writes_all_documents(spark, tmp_path):
    from areascore.testbed import QUERIES, storage

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["csv_split_records"](spark, str(tmp_path))
    assert got.count() == docs.count()
    path = storage.awkward_documents(spark, str(tmp_path))
    files = read_records(spark, path).groupBy("file").count().collect()
    assert len(files) == 4 and max(row["count"] for row in files) < docs.count() / 2
