"""Queries with SQL over few rows whose keys are those of large tables."""

import pytest

from caudal.queries import load

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = load()


@pytest.fixture
def same(spark, tmp_path):
    def check(name, table, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{table}.parquet"))
        con = duckdb.connect()
        con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
        cur = con.execute(SQL[name])
        columns = [d[0] for d in cur.description]
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).select(*columns).collect()), key=repr) == sorted(cur.fetchall(), key=repr)

    return check


def test_coordinate_repair(same):
    same("coordinate_repair", "customer", [(k,) for k in (0, 1, 20_000, 20_001, 33_364, 100_001, 110_002, 899_998, 899_999, 8_999_998)], "c_custkey long")


@pytest.mark.parametrize("name", ["geojson_written", "collection_written"])
def test_places_outside_the_box_are_written(same, name):
    same(name, "supplier", [(k, f"Supplier#{k:09d}") for k in (0, 10_999, 11_001, 59_999, 2_000_000)], "s_suppkey long, s_name string")
