"""Listing and sizing folders, checked records, number types, workbooks and silver from bronze."""

import csv
import hashlib
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from stratum import jobs
from stratum.functions.numeric import numeric_types
from stratum.plans import bronze, silver
from stratum.sources import files, listing, objects


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


def test_listing_reads_no_content(spark, tmp_path):
    put(f"{tmp_path}/a/b/one.csv", "x" * 10)
    put(f"{tmp_path}/two.json", "{}")
    put(f"{tmp_path}/_delta_log/0.json", "log")
    got = listing.list_objects(spark, str(tmp_path))
    assert {os.path.basename(r.path): r.size for r in got.collect()} == {"one.csv": 10, "two.json": 2}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan binaryFile [path#" in plan and "content#" not in plan
    assert listing.log_folders(spark, str(tmp_path), f"{tmp_path}/a")[0].endswith("_delta_log")
    assert listing.list_objects(spark, *listing.log_folders(spark, str(tmp_path))).count() == 1


def test_longest_prefix_decides(spark):
    paths = ["file:/lake/silver/t/part-1.parquet", "file:///lake/silver/t/_delta_log/0.json", "file:/lake/bronze/k/x.csv", "file:/lake/bronze/alone.xlsx",
             "file:/lake/silverish/t/x", "file:/else/x.csv", "file:/lake/bronze/k/noext"]
    rules = [listing.Prefix("file:/lake/silver/t", "silver", "parquet_data", "t"), listing.Prefix("/lake/silver/t/_delta_log/", "silver", "delta_log", "t", "json/checkpoint"),
             listing.Prefix("file:/lake/bronze", "bronze", "raw_file")]
    df = spark.createDataFrame([(p, 5) for p in paths], "path string, size long")
    got = {r.path: (r.layer, r.dataset, r.component, r.format) for r in listing.assign_prefixes(df, rules).collect()}
    assert got == {paths[0]: ("silver", "t", "parquet_data", "parquet"), paths[1]: ("silver", "t", "delta_log", "json/checkpoint"),
                   paths[2]: ("bronze", "k", "raw_file", "csv"), paths[3]: ("bronze", "alone.xlsx", "raw_file", "xlsx"), paths[6]: ("bronze", "k", "raw_file", "none")}


def test_footprint_of_written_layers(spark, tmp_path):
    put(f"{tmp_path}/bronze/raw.csv", "x" * 4000)
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/silver/unicorn_startups")
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/silver/executive_profiles")
    put(f"{tmp_path}/silver/executive_profiles/_delta_log/0.json", "12345")
    size = lambda t: sum(os.path.getsize(f"{tmp_path}/silver/{t}/{f}") for f in os.listdir(f"{tmp_path}/silver/{t}") if f.startswith("part"))
    rows = {(r.layer, r.dataset, r.component): r for r in jobs.run_footprint(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver").collect()}
    assert rows["bronze", "raw.csv", "raw_file"].value == 4000 and rows["bronze", "raw.csv", "raw_file"].format == "csv"
    for t in ("unicorn_startups", "executive_profiles"):
        assert rows["silver", t, "parquet_data"].value == size(t) and rows["silver", t, "parquet_data"].format == "parquet"
    assert rows["silver", "executive_profiles", "delta_log"].value == 5 and rows["silver", "executive_profiles", "delta_log"].format == "json/checkpoint"
    both = size("unicorn_startups") + size("executive_profiles")
    assert rows["summary", "silver_total_with_delta_log", "delta_footprint"].value == both + 5
    assert rows["summary", "parquet_data_reduction_pct", "metric"].value == round((4000 - both) / 4000 * 100, 2)


def test_broken_records_go_to_the_quarantine(spark, tmp_path):
    put(f"{tmp_path}/in/a.csv", "k,name,n\n1,Ann,5\n2,Bob\n3,\"Cy, jr\",x7\n\n4,Di,8,9\n5,\"open,6\n6,,\n")
    put(f"{tmp_path}/in/b.csv", "k,name,n\nk,name,n\n7,Ed,10\n")
    checked = files.read_csv_checked(spark, f"{tmp_path}/in", "n int, k int, name string")
    good, counts = files.quarantine(checked, f"{tmp_path}/bad", "r1")
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(5, 1, "Ann"), (None, 6, None), (10, 7, "Ed")], key=repr)
    files.quarantine(checked, f"{tmp_path}/bad", "r1")           # a repeated run replaces its own records
    bad = {(os.path.basename(r.file), r.record, r.problem) for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
    assert bad == {("a.csv", "2,Bob", "malformed"), ("a.csv", '3,"Cy, jr",x7', "bad value in n"), ("a.csv", "4,Di,8,9", "malformed"),
                   ("a.csv", '5,"open,6', "malformed"), ("b.csv", "k,name,n", "bad value in n")}
    assert {r.problem: r.records for r in counts.collect()} == {None: 3, "malformed": 3, "bad value in n": 2}
    assert sum(r.records for r in counts.collect()) == checked.count() == 8
    with pytest.raises(ValueError):
        files.read_csv_checked(spark, f"{tmp_path}/in", "missing int")


def test_types_follow_the_values(spark):
    df = spark.createDataFrame([("1", "2015.5", "x", None, "7.0"), ("NA", "2014", "1e30", None, "8")], "a string, b string, c string, d string, e string")
    assert numeric_types(df, list("abcde")) == {"a": "bigint", "b": "double", "c": "double", "d": "bigint", "e": "bigint"}
    out = silver.refine_startups(df, numeric=("a", "b", "missing"))
    assert out.dtypes[:2] == [("a", "bigint"), ("b", "double")]
    assert [(r.a, r.b) for r in out.collect()] == [(1, 2015.5), (None, 2014.0)]


def workbook(rows, inline=False):
    """A small workbook with the given rows in its first sheet."""
    strings, body = [], []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, x in enumerate(row):
            ref = f"{chr(65 + c)}{r}"
            if x is None:
                continue
            if isinstance(x, (int, float)):
                cells.append(f'<c r="{ref}"><v>{x}</v></c>')
            elif inline:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{x}</t></is></c>')
            else:
                strings.append(x)
                cells.append(f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>')
        if cells:
            body.append(f'<row r="{r}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="x" sheetId="1" r:id="rId4"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId4" Type="t" Target="worksheets/first.xml"/></Relationships>')
        z.writestr("xl/worksheets/first.xml", f'<worksheet {ns}><sheetData>{"".join(body)}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}>{"".join(f"<si><r><t>{s[:3]}</t></r><r><t>{s[3:]}</t></r></si>" for s in strings)}</sst>')
    return out.getvalue()


SHEET = [["QS ranking"], [], ["Institution Name", "Country", "QS Rank 2026"], ["University of 0", "X", "=7"], [None, None, None], ["University of 1", None, 120], ["University of 2", "Y", 33.0]]


@pytest.mark.parametrize("inline", [False, True])
def test_workbook_rows(spark, inline):
    df = spark.createDataFrame([("book.xlsx", bytearray(workbook(SHEET, inline))), ("t.csv", bytearray("﻿a,b\n\n\n\n".encode()))], "object_name string, content binary")
    got = objects.read_objects(df.where("object_name LIKE '%.xlsx'"), header_row=2)
    assert got.columns == ["Institution Name", "Country", "QS Rank 2026"]
    assert sorted(map(tuple, got.collect())) == [("University of 0", "X", "=7"), ("University of 1", None, "120"), ("University of 2", "Y", "33")]
    empty = objects.read_objects(df.where("object_name = 't.csv'"))
    assert empty.columns == ["a", "b"] and empty.count() == 0
    assert objects.read_objects(df.where("false")).columns == []


def test_delimited_objects_bind_by_name(spark):
    a = 'k,"note ""x""",z\r\n1,"two\nlines, and ""quotes""",3\r\n2,,\n,,\n'
    b = "z,k\n9,8,extra\n"
    df = spark.createDataFrame([("a.csv", bytearray(a.encode())), ("b.csv", bytearray(b.encode()))], "object_name string, content binary")
    got = objects.read_objects(df).select("k", 'note "x"', "z").collect()
    assert sorted(map(tuple, got)) == [("1", 'two\nlines, and "quotes"', "3"), ("2", None, None), ("8", None, "9")]


def test_silver_from_what_bronze_holds(spark, tmp_path):
    zone, lake = f"{tmp_path}/zone", f"{tmp_path}/lake"

    def startups(year):
        out = io.StringIO()
        w = csv.writer(out)
        w.writerow(jobs.STARTUP_COLUMNS)
        for k in range(1, 6):
            w.writerow([k, f" Acme {k}", "$2B", "Unicorn", "N/A", "C", "X", "Y", "Ann 1", year + (0.5 if k == 3 else 0), 4, "Active", "list", "d"])
        return "﻿" + out.getvalue()

    put(f"{zone}/{jobs.STARTUPS_OBJECT}", startups(2000))
    put(f"{zone}/{jobs.PROFILES_OBJECT}", "universityLabel,companyLabel,executiveLabel,degreeLabel\nUniversity of 1,Acme,Ann 1,\n")
    for year, rank in ((2025, "=900"), (2026, 120), (2019, "=1")):
        put(f"{zone}/{year} {jobs.RANKING_KEYWORD}.xlsx", workbook([[f"{year}"], [], ["Institution Name", "QS Rank"], ["University of 1", rank]]))
    bronze.land(spark, zone, f"{lake}/bronze", f"{lake}/manifest")
    put(f"{zone}/{jobs.STARTUPS_OBJECT}", startups(2010))            # a newer version of the same object
    plan = bronze.land(spark, zone, f"{lake}/bronze", f"{lake}/manifest")
    assert {r.object_name for r in plan.where("action <> 'unchanged'").collect()} == {jobs.STARTUPS_OBJECT}
    landed = {(r.object_name, r.content_md5, r.size) for r in spark.read.parquet(f"{lake}/bronze").collect()}
    assert (jobs.STARTUPS_OBJECT, hashlib.md5(startups(2010).encode()).hexdigest(), len(startups(2010).encode())) in landed and len(landed) == 6
    jobs.main(["silver", "--bronze", f"{lake}/bronze", "--manifest", f"{lake}/manifest", "--silver", f"{lake}/silver"])
    s = spark.read.parquet(f"{lake}/silver/unicorn_startups")
    assert sorted(r.Year_Founded for r in s.collect()) == [2010.0] * 4 + [2010.5] and s.where("Industry IS NULL AND Company LIKE 'Acme%'").count() == 5
    p = spark.read.parquet(f"{lake}/silver/executive_profiles").first()
    assert (p.executiveLabel, p.degreeLabel, p.QS_Rank_Num) == ("Ann 1", "Unknown", 120.0)
    assert jobs.run_silver_from_bronze(spark, f"{lake}/bronze", f"{lake}/manifest", f"{lake}/silver").startswith("2026")
    jobs.main(["gold", "--silver", f"{lake}/silver", "--gold", f"{lake}/gold"])
    assert dict(spark.read.parquet(f"{lake}/gold/fact_valuation_grit").dtypes)["year_founded"] == "double"
    with pytest.raises(FileNotFoundError):
        jobs.run_silver_from_bronze(spark, f"{lake}/bronze", f"{lake}/manifest", f"{lake}/silver", ranking_extension=".ods")
