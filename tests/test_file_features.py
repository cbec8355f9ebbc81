from __future__ import annotations

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tillstone.operators import drift
from tillstone.plans import bronze
from tillstone.plans.bronze import BronzeStore
from tillstone.sources import files, footers, workbooks


def test_files_are_left_out_by_their_footers(spark, tmp_path):
    for number in range(5):
        days = [datetime.date(2025, 1 + number, d) for d in (1, 15)] + [None]
        pq.write_table(pa.table({"day": days, "n": [number, number + 0.5, float("nan")], "s": ["a b", "c", None], "é 1": [1, 2, 3]}), tmp_path / f"{number}.parquet")
    pq.write_table(pa.table({"day": pa.array([None, None], pa.date32()), "n": [1.0, 2.0]}), tmp_path / "nulls.parquet")
    pq.write_table(pa.table({"n": [1.0]}), tmp_path / "without.parquet")
    pq.write_table(pa.table({"day": pa.array([], pa.date32())}), tmp_path / "empty.parquet")
    rows, used = footers.read_between(spark, str(tmp_path), "day", "2025-02-10", "2025-03-01", "date")
    assert sorted(str(r.day) for r in rows.collect()) == ["2025-02-15", "2025-03-01"]
    read = {r.file_path.rsplit("/", 1)[-1] for r in used.filter("was_read").collect()}
    assert read == {"1.parquet", "2.parquet"} and used.count() == 8
    rows, used = footers.read_between(spark, str(tmp_path), "s", "b", "z", "string")
    assert {r.s for r in rows.collect()} == {"c"} and used.filter("was_read").count() == 5
    rows, used = footers.read_between(spark, str(tmp_path), "day", "2030-01-01", "2031-01-01", "date")
    assert rows is None and used.filter("was_read").isEmpty()
    held = footers.file_statistics(files.list_files(spark, str(tmp_path))).filter("column_name = 'day'").collect()
    assert sum(r.rows for r in held) == 17 and sum(r.nulls or 0 for r in held) == 7
    # a file without bounds and one that is torn are not left out
    pq.write_table(pa.table({"day": [datetime.date(2025, 2, 20)]}), tmp_path / "plain.parquet", write_statistics=False)
    rows, used = footers.read_between(spark, str(tmp_path), "day", "2025-02-10", "2025-03-01", "date")
    assert rows.count() == 3
    (tmp_path / "torn.parquet").write_bytes(b"PAR1")
    chosen = footers.files_that_may_hold(footers.file_statistics(files.list_files(spark, str(tmp_path))), "day", "date", F.lit("2030-01-01").cast("date"))
    assert {r.file_path.rsplit("/", 1)[-1] for r in chosen.collect()} == {"plain.parquet", "torn.parquet"}


def test_a_shift_is_found_and_parts_merge(spark):
    rows = spark.range(40_000).select((F.col("id") % 4).alias("b"), F.rand(7).alias("x"), F.lit(1.0).alias("same"), F.when(F.col("id") % 3 > 0, F.randn(1)).alias("y"))
    rows = rows.withColumn("x", F.when(F.col("b") == 2, F.col("x") + 0.3).otherwise(F.col("x"))).withColumn("none", F.lit(None).cast("double"))
    sketches = drift.batch_sketches(rows, "b", ["x", "same", "y", "none"]).cache()
    found = {(r.batch, r.column_name): r for r in drift.batch_drift(sketches, least=0.2).collect()}
    assert {key for key, r in found.items() if r.drifted} == {(2, "x")}
    assert set(found) == {(b, c) for b in (1, 2, 3) for c in ("x", "same", "y")} and abs(found[2, "x"].drift - 0.3) < 0.03
    # a merge of parts has the ranks of the whole, within the sketch's error
    merged = drift.merged(sketches.filter("column_name = 'y'"))
    assert merged.first()["values"] == rows.filter("y is not null").count()
    points = F.array(*[F.lit(p) for p in (0.05, 0.25, 0.5, 0.75, 0.95)])
    values = merged.select(F.kll_sketch_get_quantile_double("sketch", points).alias("q")).first().q
    exact = rows.select(*[F.avg((F.col("y") <= v).cast("double")) for v in values]).first()
    assert all(abs(got - want) < 0.02 for got, want in zip(exact, (0.05, 0.25, 0.5, 0.75, 0.95), strict=True))
    assert drift.batch_drift(drift.batch_sketches(rows.limit(0), "b", ["x"])).count() == 0


def test_workbooks_are_written_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("a/b", "S & <1>", 2, "x<y>&\"z\"", " lead "), ("a/b", "S & <1>", 1, None, "é"), ("a/b", "T", 3, "l\nine", ""), ("c", "T", 4, "v", "w")],
                                 "book string, sheet string, n int, `a.b` string, `a b` string")
    log = workbooks.write_workbooks(rows, str(tmp_path), "book", "sheet", ["n"]).collect()
    assert sorted((r.file_path, r.sheets, r.rows) for r in log) == [(f"{tmp_path}/a/b.xlsx", 2, 3), (f"{tmp_path}/c.xlsx", 1, 1)]
    cells = workbooks.read_workbooks(spark, str(tmp_path))
    assert workbooks.ingest_errors(cells).isEmpty()
    found = sorted((r.file_path.rsplit("/", 1)[-1], r.sheet_name, r.row_number, r.column_number, r.value) for r in cells.collect() if r.value is not None)
    assert ("b.xlsx", "S & <1>", 0, 1, "a.b") in found and ("b.xlsx", "S & <1>", 2, 1, "x<y>&\"z\"") in found and ("b.xlsx", "S & <1>", 2, 2, " lead ") in found
    assert ("b.xlsx", "T", 1, 1, "l\nine") in found and [f for f in found if f[:3] == ("b.xlsx", "S & <1>", 1)] == [("b.xlsx", "S & <1>", 1, 0, "1"), ("b.xlsx", "S & <1>", 1, 2, "é")]


def test_deletion_in_tasks_says_what_is_gone(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "e" / "f").write_text("x")
    (tmp_path / "g").write_text("y")
    paths = spark.createDataFrame([(f"{tmp_path}/d", 1), (f"file:{tmp_path}/g", 2), (f"{tmp_path}/none", 3), ("nostore://x/y", 4)], "uri string, n int")
    found = sorted((r.n, r.deleted, r.error_message is None) for r in files.delete_listed(paths).collect())
    assert found == [(1, True, True), (2, True, True), (3, True, True), (4, False, False)] and not list(tmp_path.iterdir())


def test_torn_files_and_young_files(spark, tmp_path):
    folder = tmp_path / "landing" / "supplies" / "x" / "y"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"a": [1, 2]}), folder / "good.parquet")
    pq.write_table(pa.table({"a": [3], "b": ["n"]}), folder / "more.parquet")
    (folder / "torn.parquet").write_bytes(b"PAR1 torn")
    rows, errors = files.scan_sound(spark, str(tmp_path))
    assert sorted((r.a, r.b) for r in rows.collect()) == [(1, None), (2, None), (3, "n")]
    assert [r.file_path.rsplit("/", 1)[-1] for r in errors.collect()] == ["torn.parquet"]
    store = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    assert bronze.load_bronze(spark, str(tmp_path / "landing"), store, 1, "2025-01-01 00:00:00", settle_seconds=3600).count() == 0
    assert bronze.load_bronze(spark, str(tmp_path / "landing"), store, 2, "2025-01-01 00:00:00", settle_seconds=0).filter("status = 'SUCCESS'").count() == 2
