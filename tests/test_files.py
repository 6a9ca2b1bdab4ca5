"""CSV folders whose files differ in their headers."""

import os

import pytest
from pyspark.sql import types as T

from shopflow.schemas import RAW_CUSTOMERS
from shopflow.sources import files

HEAD = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]


def _write(path, name, header, *rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n")


def _read(spark, path):
    return sorted(map(tuple, files.read_csv(spark, path, RAW_CUSTOMERS).collect()), key=str)


def test_reversed_columns_load_right(spark, tmp):
    _write(f"{tmp}/c", "a.csv", HEAD, ("1", "u1", "rome", "RM"), ("2", "u2", "bari", "BA"))
    _write(f"{tmp}/c", "b.csv", HEAD[::-1], ("MI", "milan", "u3", "3"))
    assert _read(spark, f"{tmp}/c") == [("1", "u1", "rome", "RM"), ("2", "u2", "bari", "BA"), ("3", "u3", "milan", "MI")]
    assert len(files.csv_layouts(spark, f"{tmp}/c")) == 2


def test_missing_and_extra_columns_and_a_mark_before_the_header(spark, tmp):
    _write(f"{tmp}/c", "a.csv", HEAD[:3], ("1", "u1", "rome"))
    _write(f"{tmp}/c", "b.csv", ["﻿customer_state", "zip", "customer_id"], ("MI", "00100", "3"))
    _write(f"{tmp}/c", "c.csv", HEAD)                                  # a header without rows
    open(f"{tmp}/c/d.csv", "w").close()                                # nothing at all
    assert _read(spark, f"{tmp}/c") == [("1", "u1", "rome", None), ("3", None, None, "MI")]
    assert files.read_csv(spark, f"{tmp}/c", RAW_CUSTOMERS).columns == HEAD


def test_one_layout_is_read_as_a_folder(spark, tmp):
    for k in range(3):
        _write(f"{tmp}/c", f"{k}.csv", HEAD, (str(k), "u", " x ", "S"))
    assert files.csv_layouts(spark, f"{tmp}/c") == []
    assert [r[2] for r in _read(spark, f"{tmp}/c")] == [" x "] * 3     # blanks are data
    assert files.csv_layouts(spark, f"{tmp}/c/0.csv") == []


def test_only_the_first_rows_of_a_split_are_read(spark, tmp):
    """A file of many splits: one header, no second one from a later split."""
    _write(f"{tmp}/c", "a.csv", HEAD, *[(str(i), "u" * 50, "city", "ST") for i in range(20_000)])
    _write(f"{tmp}/c", "b.csv", HEAD[::-1], ("ST", "city", "u", "x"))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "65536")
        lines = files.first_lines(spark, f"{tmp}/c")
        assert sorted(r.header for r in lines.collect()) == sorted([",".join(HEAD), ",".join(HEAD[::-1])])
        assert files.read_csv(spark, f"{tmp}/c", RAW_CUSTOMERS).count() == 20_001
    finally:
        spark.conf.set(key, before)


def test_types_are_cast_in_every_layout(spark, tmp):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    _write(f"{tmp}/t", "x.csv", ["a", "b"], ("1", "p"), ("one", "q"))
    _write(f"{tmp}/t", "y.csv", ["b", "a"], ("r", "2"))
    got = sorted(map(tuple, files.read_csv(spark, f"{tmp}/t", schema).collect()), key=str)
    assert got == [(1, "p"), (2, "r"), (None, "q")]


def test_absent_folder_is_an_analysis_error(spark, tmp):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        files.read_csv(spark, f"{tmp}/nowhere", RAW_CUSTOMERS)
