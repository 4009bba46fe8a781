"""Delimited-text sources and landing on inputs that the driver's tables do not hold."""

import os

import pytest
from pyspark.sql import functions as F

from stratum.functions import numeric
from stratum.plans import bronze
from stratum.sources import files


def test_csv_gives_back_quotes_newlines_and_padding(spark, tmp_path):
    rows = [(1, 'a"b'), (2, 'x,"y",z'), (3, "  padded "), (4, "two\nlines"), (6, None), (7, "back\\slash"), (8, '"')]
    df = spark.createDataFrame(rows, "k int, s string")
    files.write_csv(df, str(tmp_path / "t"))
    assert sorted(tuple(r) for r in files.read_csv(spark, str(tmp_path / "t"), "k int, s string", multi_line=True).collect()) == rows


def test_csv_columns_bind_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿Company,Rank,Extra\nAcme,3,x\n")
    got = files.read_csv(spark, str(tmp_path / "t.csv"), "Rank int, Company string").collect()
    assert [tuple(r) for r in got] == [(3, "Acme")]
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "t.csv"), "Rank int, Missing string")


def test_preamble_is_dropped_by_position(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"f{k}.csv").write_text(f'MIT,1\n\nInstitution,Rank\nMIT,1\n,\n"The ""Best"" U, X",{k}\nInstitution,Rank\n\n')
    got = files.read_with_preamble(spark, str(tmp_path), header_row=2)
    assert got.columns == ["Institution", "Rank"]
    rows = sorted(tuple(r) for r in got.collect() if r.Institution)
    assert rows == sorted([("Institution", "Rank"), ("MIT", "1")] * 2 + [('The "Best" U, X', "0"), ('The "Best" U, X', "1")])
    assert got.count() == 8


def test_numbers_are_decimal_text(spark):
    texts = ["7D", "12f", "0x1p3", "2015.5", "10", " 8 ", "1e3", "-.5", "x", "", None, "NaN"]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(
        numeric.coerce_numeric("s", "double").alias("d"), numeric.coerce_numeric("s").alias("b")).collect()
    assert [r.d for r in got] == [None, None, None, 2015.5, 10.0, 8.0, 1000.0, -0.5, None, None, None, None]
    assert [r.b for r in got] == [None, None, None, None, 10, 8, 1000, None, None, None, None, None]


def test_landing_settles_after_a_change(spark, tmp_path):
    drop, lake, manifest = tmp_path / "drop", str(tmp_path / "bronze"), str(tmp_path / "manifest")
    drop.mkdir()
    (drop / "a.csv").write_text("one")
    (drop / "b.csv").write_text("same")
    (drop / "skip.bin").write_text("no")

    def actions():
        return {r.object_name: r.action for r in bronze.land(spark, str(drop), lake, manifest).collect()}

    assert actions() == {"a.csv": "new", "b.csv": "new"}
    (drop / "a.csv").write_text("two")
    assert actions() == {"a.csv": "changed", "b.csv": "unchanged"}
    for _ in range(2):
        assert actions() == {"a.csv": "unchanged", "b.csv": "unchanged"}
    assert spark.read.parquet(lake).count() == 3
    now = bronze.current_objects(spark, lake, manifest).select("object_name", F.col("content").cast("string").alias("c"))
    assert {tuple(r) for r in now.collect()} == {("a.csv", "two"), ("b.csv", "same")}
    (drop / "a.csv").write_text("one")       # back to an earlier content
    assert actions()["a.csv"] == "changed" and actions()["a.csv"] == "unchanged"
    again = bronze.current_objects(spark, lake, manifest).where("object_name = 'a.csv'").collect()
    assert [bytes(r.content) for r in again] == [b"one"]


def test_unreadable_manifest_fails(spark, tmp_path):
    os.mkdir(tmp_path / "m")
    (tmp_path / "m" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        bronze.read_manifest(spark, str(tmp_path / "m")).count()
    assert bronze.read_manifest(spark, str(tmp_path / "absent")).count() == 0
