"""Landed objects (name, content) as tables: delimited text and workbook sheets.

An object that was landed whole is one row, so it is parsed in one task.  A large one has a row for each part; its parts end at
line ends and are parsed by many tasks.
"""

from __future__ import annotations

import csv
import io
import re
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# tasks carry this module's functions themselves, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS = 5000


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter() if t.tag.endswith("}t")) for item in root if item.tag.endswith("}si")]


def _column(reference: str) -> int:
    """0-based column of a cell reference such as ``AB12``."""
    n = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(letter) - 64
    return n - 1


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The part that holds the workbook's first sheet, by its relations; sheet1.xml where they are missing."""
    try:
        sheets = next(x for x in ElementTree.fromstring(book.read("xl/workbook.xml")) if x.tag.endswith("}sheets"))
        wanted = next(v for k, v in sheets[0].attrib.items() if k.endswith("}id"))
        relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = next(r.attrib["Target"] for r in relations if r.attrib["Id"] == wanted).lstrip("/")
        return target if target.startswith("xl/") else f"xl/{target}"
    except (KeyError, StopIteration, IndexError):
        return "xl/worksheets/sheet1.xml"


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """The rows of a workbook's first sheet as text, by their row numbers; missing rows are empty lists."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, at = _shared_strings(book), 0
        with book.open(_first_sheet(book)) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if not row.tag.endswith("}row"):
                    continue
                number = int(row.attrib.get("r", at + 1))
                yield from ([] for _ in range(at + 1, number))
                at, out = number, []
                for place, cell in enumerate(row):
                    k = _column(cell.attrib["r"]) if "r" in cell.attrib else place
                    out += [None] * (k + 1 - len(out))
                    kind = cell.attrib.get("t")
                    if kind == "inlineStr":
                        out[k] = "".join(t.text or "" for t in cell.iter() if t.tag.endswith("}t"))
                    else:
                        value = next((v.text for v in cell if v.tag.endswith("}v")), None)
                        if value is not None and kind == "s":
                            value = strings[int(value)]
                        elif value is not None and kind in (None, "n") and re.fullmatch(r"-?\d+\.0", value):
                            value = value[:-2]
                        out[k] = value
                yield out
                row.clear()


def text_rows(content: bytes) -> Iterator[list[str | None]]:
    """Records of delimited text with doubled quotes; a byte order mark is dropped, line ends inside quotes are kept.

    Empty lines are empty lists.  An empty unquoted or quoted field is null, as in ``files.read_csv``.
    """
    text = io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig", newline="")
    for record in csv.reader(text):
        yield [x if x != "" else None for x in record]


def _rows(name: str, content: bytes) -> Iterator[list[str | None]]:
    return sheet_rows(content) if name.lower().endswith(".xlsx") else text_rows(content)


def _header(name: str, content: bytes, header_row: int) -> list[str]:
    for k, row in enumerate(_rows(name, content)):
        if k == header_row:
            return [(x or "").strip() or f"_c{i}" for i, x in enumerate(row)]
    return []


def _headers(header_row: int):
    def run(batches):
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays([pa.array([_header(name, content, header_row)], pa.list_(pa.string()))], names=["names"])
    return run


def _parsed(header: list[str], names: list[str], header_row: int):
    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)

    def run(batches):
        for batch in batches:
            for name, content, part in zip(*(c.to_pylist() for c in batch.columns)):
                mine = header if part else _header(name, content, header_row)
                at = [mine.index(n) if n in mine else None for n in names]
                held = []
                for k, row in enumerate(_rows(name, content)):
                    if (part or k > header_row) and any(x is not None for x in row):
                        held.append([row[i] if i is not None and i < len(row) else None for i in at])
                        if len(held) == ROWS:
                            yield out(held)
                            held = []
                if held:
                    yield out(held)
    return run


def read_objects(objects: DataFrame, header_row: int = 0) -> DataFrame:
    """All records of ``objects(object_name, content)`` as text columns.

    ``.xlsx`` objects are read as workbooks (first sheet), all others as delimited text.  The header is on row ``header_row``
    (0-based, workbook rows by their numbers); records without any value are no rows.  Columns bind by name; an object that lacks one has
    nulls there.  Two passes: the headers alone go to the driver (distinct ones), then the records are parsed.  No object gives an empty
    table without columns.  A column ``part`` marks objects in several rows: part 0 has the header, the others are read with it, which needs one
    object (or equal headers) and records without line ends inside quotes.
    """
    part = F.col("part") if "part" in objects.columns else F.lit(0)
    source = objects.select("object_name", "content", part.cast("long").alias("part"))
    headers = source.where("part = 0").select("object_name", "content").mapInArrow(_headers(header_row), "names array<string>").distinct().collect()
    names = list(dict.fromkeys(n for r in sorted(headers, key=lambda r: r[0]) for n in r[0]))
    header = headers[0][0] if len(headers) == 1 else None
    if header is None and not source.where("part > 0").isEmpty():
        raise ValueError("objects in parts need one header")
    if not names:
        return objects.sparkSession.createDataFrame([], "struct<>")
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    return source.mapInArrow(_parsed(header, names, header_row), schema)
