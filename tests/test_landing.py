"""Landing run over hand-made workbooks, and the file-level silver run."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
from test_workbooks import SHEET, cell, write

from tillstone.plans import landing, silver_files


def _sheet(rows):
    body = "<row r='1'>" + cell("A1", "Name", "inlineStr") + cell("B1", "Unit Price", "inlineStr") + "</row>"
    for n, (name, price) in enumerate(rows, 2):
        body += f"<row r='{n}'>" + cell(f"A{n}", name, "inlineStr") + cell(f"B{n}", price) + "</row>"
    return SHEET.format(body)


def test_landing_run(spark, tmp_path):
    root = tmp_path / "in"
    (root / "sales").mkdir(parents=True)
    write(root / "sales" / "one.xlsx", {"Jan 1": _sheet([("a", 1), ("b", 2)]), "Feb": _sheet([("c", 3)])})
    write(root / "two.xlsx", {"Jan": _sheet([("d", 4)]), "Torn": _sheet([("e", 5), ("f", 6)])[:-40]})
    (root / "bad.xlsx").write_bytes(b"no zip")
    store = landing.LandingStore(str(tmp_path / "landed"), str(tmp_path / "logs"))
    stats = landing.run_landing(spark, str(root), store, "2025-01-01").first()
    assert (stats.total_files, stats.total_sheets, stats.success_count, stats.failure_count) == (3, 3, 1, 2)
    assert (stats.total_excel_rows, stats.total_parquet_rows, stats.files_with_row_mismatch) == (4, 4, 0)
    held = {r.file_path.rsplit("/", 1)[-1]: r for r in landing.manifest(spark, store).collect()}
    assert held["one.xlsx"].sheets_processed == ["Feb", "Jan 1"] and held["two.xlsx"].sheets_processed == ["Jan"]
    assert "Torn" in held["two.xlsx"].error_message and held["bad.xlsx"].output_files == []
    landed = [landing.read_landed(spark, store, o) for r in held.values() for o in r.output_files]
    rows = sorted((r.Name, r.Unit_Price, r._source_sheet) for t in landed for r in t.collect())
    assert rows == [("a", "1", "Jan 1"), ("b", "2", "Jan 1"), ("c", "3", "Feb"), ("d", "4", "Jan")]
    # only the failed and the changed workbooks come up again
    write(root / "sales" / "one.xlsx", {"Jan 1": _sheet([("a", 1)])})
    again = landing.run_landing(spark, str(root), store, "2025-01-02").first()
    assert (again.total_files, again.total_excel_rows) == (3, 2)
    (root / "two.xlsx").unlink()
    gone = landing.clean_orphans(spark, str(root), store, "2025-01-03")
    assert len(gone) == 1 and "two" in gone[0]
    assert {r.file_path.rsplit("/", 1)[-1] for r in landing.manifest(spark, store).collect()} == {"one.xlsx", "bad.xlsx"}
    assert landing.reconciliation([landing.manifest(spark, store)]).count() == 0


def test_silver_file_run(spark, tmp_path):
    root = tmp_path / "bronze" / "a b"
    root.mkdir(parents=True)
    pq.write_table(pa.table({"Unit Price": [1.0, None, 1.0], "Name": ["x", None, "x"]}), root / "one.parquet")
    (root / "bad.parquet").write_bytes(b"no")
    target, log = str(tmp_path / "silver"), str(tmp_path / "log")
    steps = ("names", "fill", "types", "distinct")
    first = silver_files.run_silver_files(spark, str(tmp_path / "bronze"), target, log, "2025-01-01", steps)
    found = {r.file_path.rsplit("/", 1)[-1]: r for r in first.collect()}
    assert found["bad.parquet"].status == "FAILED" and found["one.parquet"].row_count == 2
    assert found["one.parquet"].transformations_applied == ["column_name_standardization", "missing_value_handling", "duplicate_removal(1 rows)"]
    rows = spark.read.parquet(found["one.parquet"].output_path).select("unit_price", "name").collect()
    assert sorted(map(tuple, rows)) == [(0.0, "Unknown"), (1.0, "x")]
    second = silver_files.run_silver_files(spark, str(tmp_path / "bronze"), target, log, "2025-01-02", steps)
    assert [r.file_path.rsplit("/", 1)[-1] for r in second.collect()] == ["bad.parquet"]
