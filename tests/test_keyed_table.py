"""A stored table that is updated in place."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerpulse.sources.keyed_table import KeyedTable

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("status", T.IntegerType()), T.StructField("note", T.StringType())])


def rows(table):
    return sorted(map(tuple, table.read().collect()), key=str)


def test_update_rewrites_only_touched_parts(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "id", 8)
    assert rows(table) == []
    first = [(f"k{i}", i, None if i % 3 else "n") for i in range(40)]
    table.upsert(spark.createDataFrame(first, SCHEMA))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    change = spark.createDataFrame([("k5", 200), ("k5", 100), ("k6", None), ("gone", 1), (None, 3)], "id string, status int")
    touched = table.update(change)
    expected = sorted(((k, 200 if k == "k5" else s, n) for k, s, n in first), key=str)
    assert rows(table) == expected
    assert table.update(change) == touched and rows(table) == expected  # twice is once
    kept = {p for p in (tmp_path / "t").rglob("*.parquet")} & set(before)
    assert len(touched) < 8 and kept and all(p.stat().st_mtime_ns == before[p] for p in kept)
    assert all(int(p.parent.name.split("=")[1]) not in touched for p in kept)


def test_upsert_replaces_and_adds(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "id", 4)
    table.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SCHEMA))
    for _ in range(2):
        table.upsert(spark.createDataFrame([("b", 3, None), ("c", 4, "z"), ("c", 5, "z")], SCHEMA))
    assert sorted(rows(table), key=lambda r: r[0]) == [("a", 1, "x"), ("b", 3, None), ("c", 5, "z")]
    assert table.upsert(spark.createDataFrame([], SCHEMA)) == []
    with pytest.raises(Exception, match="needs its key"):
        table.upsert(spark.createDataFrame([(None, 1, "x")], SCHEMA))
    assert table.read().filter(F.col("id") == "a").count() == 1
