"""Workbook ingest: one cell stream per tree, then rows by header.

A task opens one workbook at a time and reads its sheets as a stream, so memory follows the
workbook's shared texts and not its rows. Everything after the cells is plain DataFrame work.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import groupby
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstone.functions.naming import clean_headers, quoted, strip_scheme
from tillstone.operators.profile import drop_empty_columns, drop_empty_rows
from tillstone.sources.files import WORKBOOK_GLOB, create_file

CELL_SCHEMA = "file_path string, sheet_name string, row_number int, column_number int, value string, error_message string"
_CELL_NAMES = ["file_path", "sheet_name", "row_number", "column_number", "value", "error_message"]
_CELL_TYPES = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
_BATCH_ROWS = 20_000
_DECODED_SUFFIXES = (".xlsx", ".xlsm")

# Fixed values of the workbook format: number formats that mean a date or time, and day zero.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_DAY_ZERO = datetime(1899, 12, 30)
_DAY_ZERO_1904 = datetime(1904, 1, 1)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _children(book: zipfile.ZipFile, name: str, wanted: str) -> list[ElementTree.Element]:
    if name not in book.namelist():
        return []
    return [node for node in ElementTree.fromstring(book.read(name)).iter() if _local(node.tag) == wanted]


def _text_of(node: ElementTree.Element) -> str:
    return "".join(part.text or "" for part in node.iter() if _local(part.tag) == "t")


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    return [_text_of(node) for node in _children(book, "xl/sharedStrings.xml", "si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Style numbers whose number format shows a date or time."""
    name = "xl/styles.xml"
    custom = {}
    for node in _children(book, name, "numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", node.get("formatCode", ""))
        custom[int(node.get("numFmtId", "-1"))] = bool(re.search(r"[dmyhs]", code, re.IGNORECASE))
    styles = set()
    for block in _children(book, name, "cellXfs"):
        for index, style in enumerate(block):
            number_format = int(style.get("numFmtId", "0"))
            if custom.get(number_format, number_format in _DATE_FORMATS):
                styles.add(index)
    return styles


def _sheet_files(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    targets = {
        node.get("Id"): node.get("Target", "")
        for node in _children(book, "xl/_rels/workbook.xml.rels", "Relationship")
    }
    sheets = []
    for node in _children(book, "xl/workbook.xml", "sheet"):
        link = next((value for key, value in node.attrib.items() if _local(key) == "id"), "")
        target = targets.get(link, "").lstrip("/")
        sheets.append((node.get("name", ""), target if target.startswith("xl/") else f"xl/{target}"))
    return sheets


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def _day_text(serial: float, day_zero: datetime) -> str:
    moment = day_zero + timedelta(seconds=round(serial * 86400))
    return moment.strftime("%Y-%m-%d %H:%M:%S")


def _sheet_cells(
    stream: io.BufferedIOBase, texts: list[str], date_styles: set[int], day_zero: datetime
) -> Iterator[tuple[int, int, str]]:
    row_number, next_column, rows = -1, 0, None
    for event, node in ElementTree.iterparse(stream, events=("start", "end")):
        tag = _local(node.tag)
        if event == "start":
            if tag == "row":
                row_number = int(node.get("r", row_number + 2)) - 1
                next_column = 0
            elif tag == "sheetData":
                rows = node
            continue
        if tag == "row" and rows is not None:
            rows.clear()  # drops the finished row from its parent, so memory does not grow with rows
        if tag != "c":
            continue
        reference = node.get("r")
        column = _column_number(reference) if reference else next_column
        next_column = column + 1
        kind = node.get("t", "n")
        if kind == "inlineStr":
            value = _text_of(node)
        else:
            value = next((child.text for child in node if _local(child.tag) == "v"), None)
        if value is None or value == "":
            continue
        if kind == "s":
            value = texts[int(value)]
        elif kind == "b":
            value = "True" if value == "1" else "False"
        elif kind == "n" and int(node.get("s", "0")) in date_styles:
            value = _day_text(float(value), day_zero)
        elif kind == "e":
            continue
        yield row_number, column, value


def _workbook_cells(path: str, content: bytes) -> Iterator[tuple]:
    """(path, sheet, row, column, value, error) of one workbook; a bad sheet is one error row."""
    if not path.lower().endswith(_DECODED_SUFFIXES):
        yield path, None, None, None, None, "only .xlsx and .xlsm workbooks can be decoded"
        return
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        texts, date_styles, sheets = _shared_texts(book), _date_styles(book), _sheet_files(book)
        properties = _children(book, "xl/workbook.xml", "workbookPr")
        is_1904 = any(node.get("date1904") in ("1", "true") for node in properties)
    except Exception as error:
        yield path, None, None, None, None, f"unreadable workbook: {error}"
        return
    for sheet, part in sheets:
        try:
            with book.open(part) as stream:
                day_zero = _DAY_ZERO_1904 if is_1904 else _DAY_ZERO
                for row, column, value in _sheet_cells(stream, texts, date_styles, day_zero):
                    yield path, sheet, row, column, value, None
        except Exception as error:
            yield path, sheet, None, None, None, f"unreadable sheet: {error}"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(values), kind) for values, kind in zip(columns, _CELL_TYPES)], _CELL_NAMES
        )

    pending: list[tuple] = []
    for batch in batches:
        for path, content in zip(batch["file_path"].to_pylist(), batch["content"]):
            for cell in _workbook_cells(path, content.as_py()):
                pending.append(cell)
                if len(pending) >= _BATCH_ROWS:
                    yield as_batch(pending)
                    pending = []
    if pending:
        yield as_batch(pending)


def read_workbooks(spark: SparkSession, root: str, glob: str = WORKBOOK_GLOB) -> DataFrame:
    """Cells of every workbook below ``root``; files and sheets that fail are rows with an error."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    try:
        files = reader.load(root)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], CELL_SCHEMA)
        raise
    contents = files.select(strip_scheme(F.col("path")).alias("file_path"), "content")
    return contents.mapInArrow(_cells, CELL_SCHEMA)


def ingest_errors(cells: DataFrame) -> DataFrame:
    """Files and sheets that could not be read."""
    return cells.filter(F.col("error_message").isNotNull()).select("file_path", "sheet_name", "error_message")


def sound_cells(cells: DataFrame) -> DataFrame:
    """Cells of the sheets that were read to their end; a sheet that broke midway counts as unread."""
    broken = ingest_errors(cells).filter(F.col("sheet_name").isNotNull()).select("file_path", "sheet_name").distinct()
    return cells.filter(F.col("error_message").isNull()).join(broken, ["file_path", "sheet_name"], "left_anti")


def headers(cells: DataFrame) -> DataFrame:
    """Column names per sheet, from its first row, with columns that hold no data left out.

    A sheet has at most 16,384 columns, so its header list is small.
    """
    columns = sound_cells(cells).groupBy("file_path", "sheet_name", "column_number").agg(
        F.max(F.when(F.col("row_number") == 0, F.col("value"))).alias("header"),
        F.count_if(F.col("row_number") > 0).alias("filled"),
    )
    named = columns.filter("filled > 0").withColumn(
        "header",
        F.coalesce("header", F.concat(F.lit("Unnamed: "), F.col("column_number").cast("string"))),
    )
    cleaned = F.translate(F.regexp_replace("header", r"^\s+|\s+$", ""), " .", "__")
    sheet = Window.partitionBy("file_path", "sheet_name", "name")
    number = F.row_number().over(sheet.orderBy("column_number")) - 1
    repeats = F.count(F.lit(1)).over(sheet)
    numbered = named.withColumn("name", cleaned).withColumns({"number": number, "repeats": repeats})
    final = F.when(F.col("repeats") == 1, F.col("name")).otherwise(
        F.concat("name", F.lit("_"), F.col("number").cast("string"))
    )
    return numbered.select("file_path", "sheet_name", "column_number", final.alias("column_name"))


def sheet_rows(cells: DataFrame) -> DataFrame:
    """One row per non-empty data row: file, sheet, row number and a map of column to text."""
    data = sound_cells(cells).filter(F.col("row_number") > 0)
    named = data.join(headers(cells), ["file_path", "sheet_name", "column_number"])
    entries = F.collect_list(F.struct("column_name", "value"))
    return named.groupBy("file_path", "sheet_name", "row_number").agg(F.map_from_entries(entries).alias("cells"))


def cells_to_table(rows: DataFrame, columns: list[str], processed_at: str) -> DataFrame:
    """Text columns of sheets that share a header, with landing lineage."""
    return rows.select(
        *[F.col("cells").getItem(name).alias(name) for name in columns],
        F.col("sheet_name").alias("_source_sheet"),
        F.lit(processed_at).alias("_processed_at"),
        "file_path",
    )


def sheet_columns(rows: DataFrame) -> list[str]:
    """Column names over all sheets, bounded by the distinct headers."""
    names = rows.select(F.explode(F.map_keys("cells")).alias("name")).distinct().orderBy("name")
    return [row.name for row in names.collect()]


def landing_counts(cells: DataFrame) -> DataFrame:
    """Rows per sheet counted both ways: filled first column, and any filled column."""
    data = sound_cells(cells).filter(F.col("row_number") > 0)
    per_row = data.groupBy("file_path", "sheet_name", "row_number").agg(
        F.count_if(F.col("column_number") == 0).alias("first_filled")
    )
    return per_row.groupBy("file_path", "sheet_name").agg(
        F.count_if(F.col("first_filled") > 0).alias("first_column_rows"), F.count(F.lit(1)).alias("data_rows")
    )


def clean_sheet(df: DataFrame) -> DataFrame:
    """An already tabular sheet without empty rows and columns, with cleaned headers."""
    kept = drop_empty_columns(drop_empty_rows(df))
    return kept.toDF(*clean_headers(kept.columns))


# Fixed values of the workbook format: names of its parts and of the links between them.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOCUMENT_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE_LINKS = "http://schemas.openxmlformats.org/package/2006/relationships"
_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _row_text(number: int, values: list) -> bytes:
    cells = "".join("<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for v in values)
    return f'<row r="{number}">{cells}</row>'.encode()


def _write_book(handle, columns: list[str], rows: Iterator[tuple]) -> tuple[int, int]:
    """Write rows (sheet, values), which come sheet by sheet, as they come; returns numbers of sheets and rows."""
    names, total = [], 0
    with zipfile.ZipFile(handle, "w", zipfile.ZIP_DEFLATED) as book:
        for sheet, members in groupby(rows, key=lambda row: row[0]):
            names.append(sheet)
            with book.open(f"xl/worksheets/sheet{len(names)}.xml", "w") as part:
                part.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode() + _row_text(1, columns))
                for number, (_, values) in enumerate(members, 2):
                    part.write(_row_text(number, values))
                    total += 1
                part.write(b"</sheetData></worksheet>")
        listed = list(enumerate(names, 1))
        sheets = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in listed)
        links = "".join(f'<Relationship Id="rId{i}" Type="{_DOCUMENT_LINKS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in listed)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_KIND}.worksheet+xml"/>' for i, _ in listed)
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOCUMENT_LINKS}"><sheets>{sheets}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE_LINKS}">{links}</Relationships>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE_LINKS}"><Relationship Id="rId1" Type="{_DOCUMENT_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("[Content_Types].xml", f'<Types xmlns="{_TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                                             f'<Override PartName="/xl/workbook.xml" ContentType="{_KIND}.sheet.main+xml"/>{kinds}</Types>')
    return len(names), total


def write_workbooks(rows: DataFrame, root: str, workbook: str, sheet: str, order: list[str]) -> DataFrame:
    """Write a workbook ``<root>/<workbook>.xlsx`` for each value, a sheet for each of its sheets, as text cells.

    Rows come to tasks sorted and are written as they come, so a task holds one row at a time. Returns
    (file_path, sheets, rows); the files are written as it is evaluated, and a task that is run again
    replaces them.
    """
    columns = [name for name in rows.columns if name not in (workbook, sheet)]
    texts = rows.select(F.col(workbook).alias("__book"), F.col(sheet).alias("__sheet"), *[F.col(quoted(name)).cast("string").alias(f"c{i}") for i, name in enumerate(columns)],
                        F.struct(*[F.col(quoted(name)) for name in order]).alias("__order"))
    placed = texts.repartition("__book").sortWithinPartitions("__book", "__sheet", "__order").drop("__order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = ((row[0], (row[1], list(row[2:]))) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        written = []
        for book, members in groupby(listed, key=lambda row: row[0]):
            path = f"{root}/{book}.xlsx"
            with create_file(path) as handle:
                written.append((path, *_write_book(handle, columns, (row for _, row in members))))
        kinds = (pa.string(), pa.int32(), pa.int64())
        parts = list(zip(*written, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(parts, kinds, strict=True)], names=["file_path", "sheets", "rows"])

    return placed.mapInArrow(run, "file_path string, sheets int, rows bigint")
