"""Area queries on tables in which customers and facts do not hold the same keys."""

import shutil

import duckdb
import pytest
from compare import connect, difference

from areascore.scratch import release
from areascore.testbed import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def uneven(tmp_path_factory):
    """Events of people who are no customers, and customers without any rows."""
    folder = tmp_path_factory.mktemp("uneven")
    shutil.copytree(SF_DIR, folder, dirs_exist_ok=True, copy_function=shutil.copyfile)
    for name, rows in {
        "events": "SELECT * REPLACE (user_id + 1000000 * (user_id % 3 // 2) AS user_id) FROM '{0}'",
        "customer": "SELECT * FROM '{0}' UNION ALL SELECT * REPLACE (c_custkey + 500000 AS c_custkey, -1.0 AS c_acctbal) FROM '{0}'",
    }.items():
        (folder / f"{name}.parquet").unlink()
        duckdb.sql(f"COPY ({rows.format(f'{SF_DIR}/{name}.parquet')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["override_impute", "fill_structural_nulls", "area_score"])
def test_areas_are_those_with_rows(spark, uneven, name):
    with connect(uneven) as con:
        assert difference(spark, con, QUERIES[name], SQL[name], uneven) is None
    release(spark)
