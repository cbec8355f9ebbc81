"""Workbook ingest from minimal hand-made files."""

from __future__ import annotations

import zipfile

from tillstone.sources import workbooks

SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'


def cell(ref, value, kind=None, style=None):
    if kind == "inlineStr":
        return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
    marks = (f' t="{kind}"' if kind else "") + (f' s="{style}"' if style is not None else "")
    return f'<c r="{ref}"{marks}><v>{value}</v></c>'


def write(path, sheets, texts=()):
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns:r="r"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        book.writestr("xl/sharedStrings.xml", "<sst>" + "".join(f"<si><t>{t}</t></si>" for t in texts) + "</sst>")
        book.writestr("xl/styles.xml", '<styleSheet><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, body in enumerate(sheets.values(), 1):
            if body is not None:
                book.writestr(f"xl/worksheets/s{i}.xml", body)


def test_workbooks_become_rows(spark, tmp_path):
    header = "<row r='1'>" + cell("A1", 0, "s") + cell("B1", 1, "s") + cell("C1", 1, "s") + cell("D1", "gone", "inlineStr") + "</row>"
    first = "<row r='2'>" + cell("A2", "12.5") + cell("B2", "x", "inlineStr") + cell("C2", 45688, None, 1) + "</row>"
    third = "<row r='4'>" + cell("B4", "1", "b") + "</row>"
    write(tmp_path / "a.xlsx", {
        "Jan": SHEET.format(header + first + third), "Empty": SHEET.format(""), "Lost": None,
    }, ["Unit Price", "a.b"])
    (tmp_path / "broken.xlsx").write_bytes(b"zip? no")
    (tmp_path / "old.xls").write_bytes(b"old")
    (tmp_path / "note.txt").write_text("ignored")
    cells = workbooks.read_workbooks(spark, str(tmp_path)).cache()
    errors = {(r.file_path.rsplit("/", 1)[-1], r.sheet_name) for r in workbooks.ingest_errors(cells).collect()}
    assert errors == {("broken.xlsx", None), ("old.xls", None), ("a.xlsx", "Lost")}
    rows = workbooks.sheet_rows(cells)
    names = workbooks.sheet_columns(rows)
    assert names == ["Unit_Price", "a_b_0", "a_b_1"]
    table = workbooks.cells_to_table(rows, names, "2025-02-01T00:00:00").drop("file_path").collect()
    assert {tuple(r) for r in table} == {
        ("12.5", "x", "2025-01-31 00:00:00", "Jan", "2025-02-01T00:00:00"),
        (None, "True", None, "Jan", "2025-02-01T00:00:00"),
    }
    counts = workbooks.landing_counts(cells).first()
    assert (counts.first_column_rows, counts.data_rows) == (1, 2)
    assert workbooks.read_workbooks(spark, str(tmp_path / "nowhere")).count() == 0


def test_tabular_sheet_is_cleaned(spark):
    df = spark.createDataFrame(
        [("a", None, 1), (None, None, None), ("b", None, 2)], "`Unit Price` string, `b.lank` string, `a.b` int"
    )
    cleaned = workbooks.clean_sheet(df)
    assert cleaned.columns == ["Unit_Price", "a_b"] and cleaned.count() == 2
