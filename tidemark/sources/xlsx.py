"""Spreadsheet source: the first sheet of .xlsx files as text, read from the zipped XML itself."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from glob import glob
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions.cleaning import missing_to_null

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Built-in number formats that show dates.
_DATES = frozenset([*range(14, 23), *range(45, 48)])
_EPOCH = datetime(1899, 12, 30)
#: Rows of a sheet that are passed on together.
BATCH = 4096


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")) for f in root.iter(f"{_MAIN}numFmt")}
    cells = root.find(f"{_MAIN}cellXfs")
    formats = [int(x.get("numFmtId", 0)) for x in cells] if cells is not None else []
    return {i for i, f in enumerate(formats) if f in _DATES or re.search("[ymdh]", own.get(f, ""), re.I)}


def rows_of(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet; dates as ISO text, whole numbers without a fraction."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        texts: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                texts.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets")
        target = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        path = target[sheets[0].get(f"{_REL}id")].lstrip("/")
        dates = _date_styles(book)
        with book.open(path if path.startswith("xl/") else f"xl/{path}") as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str | None] = []
                for k, c in enumerate(row.iter(f"{_MAIN}c")):
                    at = _column(c.get("r")) if c.get("r") else k
                    cells += [None] * (at + 1 - len(cells))
                    kind, value = c.get("t"), c.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif value is None or value.text is None:
                        cells[at] = None
                    elif kind == "s":
                        cells[at] = texts[int(value.text)]
                    elif kind == "b":
                        cells[at] = "True" if value.text == "1" else "False"
                    elif kind in (None, "n") and int(c.get("s", 0)) in dates:
                        cells[at] = str(_EPOCH + timedelta(seconds=round(float(value.text) * 86400)))
                    elif kind in (None, "n"):
                        number = float(value.text)
                        cells[at] = str(int(number)) if number.is_integer() and abs(number) < 1e15 else value.text
                    else:
                        cells[at] = value.text
                row.clear()
                yield cells


def header_of(content: bytes) -> list[str] | None:
    """Column names of the first sheet, made distinct; None if the file cannot be read."""
    from tidemark.sources.files import distinct_names

    try:
        first = next(rows_of(content), None)
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, IndexError, TypeError, ValueError):
        return None
    return distinct_names([c if c is not None else f"Unnamed: {i}" for i, c in enumerate(first)]) if first else None


def sheet_batches(content: bytes, width: int, size: int = BATCH) -> Iterator[list[list[str | None]]]:
    """Rows below the header, ``size`` at a time, cut or filled up to ``width`` cells; rows without a value are left out."""
    rows = rows_of(content)
    next(rows, None)
    held: list[list[str | None]] = []
    for r in rows:
        if any(c is not None for c in r):
            held.append((r + [None] * width)[:width])
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


class XlsxSource(DataSource):
    """``spark.read.format("xlsx").load(pattern)``: first sheets as text, a partition a file, rows in batches.

    For folders that all executors have mounted; ``scan_xlsx`` reads any store. The columns are those of
    ``schema`` or, without one, of the first file's header; ``_file`` is not among them.
    """

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _paths(self) -> list[str]:
        pattern = self.options["path"].removeprefix("file://")
        found = sorted(str(f) for f in Path(pattern).glob("*.xlsx")) if Path(pattern).is_dir() else sorted(glob(pattern))
        if not found:
            raise FileNotFoundError(f"no spreadsheet at {pattern}")
        return found

    def schema(self) -> T.StructType:
        names = header_of(Path(self._paths()[0]).read_bytes())
        if not names:
            raise ValueError(f"{self._paths()[0]} has no header")
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _XlsxReader(self._paths(), schema.names, int(self.options.get("batch", BATCH)))


class _XlsxReader(DataSourceReader):
    def __init__(self, paths: list[str], names: list[str], size: int) -> None:
        self.paths, self.names, self.size = paths, names, size

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for cells in sheet_batches(Path(partition.value).read_bytes(), len(self.names), self.size):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*cells, strict=True)], names=self.names)


def scan_xlsx(spark: SparkSession, paths: list[str], columns: list[str], file: str | None = None) -> DataFrame:
    """The first sheets of files of one known layout as text columns, missing values as null.

    Bytes come through Spark's own binary reader, so any store that Spark reads will do. ``file`` names a
    further column for the file that a row comes from.
    """
    width = len(columns)

    def run(batches):
        for batch in batches:
            for content, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for cells in sheet_batches(content, width):
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in zip(*cells, strict=True)], pa.array([name] * len(cells), pa.string())], names=[*[f"c{i}" for i in range(width)], "name"])

    raw = spark.read.format("binaryFile").load(paths).select("content", F.substring_index("path", "/", -1).alias("name"))
    raw = raw.mapInArrow(run, ", ".join([*[f"c{i} string" for i in range(width)], "name string"]))
    origin = [F.col("name").alias(file)] if file else []
    return raw.select(*origin, *[missing_to_null(F.col(f"c{i}")).alias(c) for i, c in enumerate(columns)])
