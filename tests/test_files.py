"""Landing trees: bronze load, streaming load, warehouse upload, medallion run."""

from __future__ import annotations


import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillstone.operators.schema_evolution import ADD_COLUMN, REMOVE_COLUMN, TYPE_CHANGE
from tillstone.plans import bronze, medallion, warehouse
from tillstone.plans.bronze import BronzeStore
from tillstone.sources import files, sinks
from tillstone.streaming.bronze_stream import stream_bronze

DETAILED = "bronze_sales_cash_invoices_detailed"


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    month = root / "sales" / "cash_invoices" / "detailed" / "2025" / "january"
    month.mkdir(parents=True)
    (root / "supplies").mkdir()
    base = {"DOCUMENT_NUMBER": ["INV1", "INV2 "], "AMOUNT": [10.0, -3.5]}
    pq.write_table(pa.table(base), month / "a.parquet")
    pq.write_table(pa.table({**base, "EXTRA": ["x", "y"]}), month / "b.parquet")
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["INV3"]}), month / "c.parquet")
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["INV4"], "AMOUNT": ["12.5"]}), month / "d.parquet")
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["INV5"], "AMOUNT": ["abc"]}), month / "e.parquet")
    (month / "broken.parquet").write_bytes(b"not parquet at all")
    (month / "note.txt").write_text("ignored")
    pq.write_table(pa.table({"n": [1, 2, 3]}), root / "sales" / "short.parquet")
    return root


@pytest.fixture
def store(tmp_path):
    return BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))


def statuses(log):
    return {row.file_path.rsplit("/", 1)[-1]: (row.status, row.records_count) for row in log.collect()}


def test_load_matches_columns_by_name_and_isolates_bad_files(spark, landing, store):
    log = bronze.load_bronze(spark, str(landing), store, 1, "2025-02-01 00:00:00")
    assert statuses(log) == {
        "a.parquet": ("SUCCESS", 2), "b.parquet": ("SUCCESS", 2), "c.parquet": ("SUCCESS", 1),
        "d.parquet": ("SUCCESS", 1), "e.parquet": ("FAILED", None), "broken.parquet": ("FAILED", None),
        "short.parquet": ("SUCCESS", 3),
    }
    table = sinks.read_table_or_none(spark, store.table(DETAILED))
    rows = {(r.DOCUMENT_NUMBER, r.AMOUNT, r.EXTRA) for r in table.collect()}
    assert rows == {
        ("INV1", 10.0, None), ("INV2 ", -3.5, None), ("INV1", 10.0, "x"), ("INV2 ", -3.5, "y"),
        ("INV3", None, None), ("INV4", 12.5, None),
    }
    assert {f.name: f.dataType.simpleString() for f in table.schema.fields}["load_timestamp"] == "timestamp_ntz"
    assert {r.batch_id for r in table.collect()} == {1}
    assert all(not r.source_file_path.startswith("file:") for r in table.collect())
    changes = spark.read.parquet(store.log("schema_evolution"))
    found = {(r.change_type, r.column_name) for r in changes.collect()}
    assert {(ADD_COLUMN, "EXTRA"), (REMOVE_COLUMN, "AMOUNT"), (TYPE_CHANGE, "AMOUNT")} <= found
    short = sinks.read_table_or_none(spark, store.table("bronze_sales_short.parquet"))
    assert short.count() == 3


def test_second_load_takes_only_failed_new_and_changed_files(spark, landing, store):
    bronze.load_bronze(spark, str(landing), store, 1, "2025-02-01 00:00:00")
    month = landing / "sales" / "cash_invoices" / "detailed" / "2025" / "january"
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["INV9"], "AMOUNT": [1.0]}), month / "new.parquet")
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["INV3", "INV33"], "AMOUNT": [1.0, 2.0]}), month / "c.parquet")
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["INV5"], "AMOUNT": ["7"]}), month / "e.parquet")
    log = bronze.load_bronze(spark, str(landing), store, 2, "2025-02-02 00:00:00")
    loaded = statuses(log)
    assert loaded == {
        "new.parquet": ("SUCCESS", 1), "c.parquet": ("SUCCESS", 2), "e.parquet": ("SUCCESS", 1),
        "broken.parquet": ("FAILED", None),
    }
    table = sinks.read_table_or_none(spark, store.table(DETAILED))
    assert table.count() == 6 + 4
    current = bronze.current_rows(table, bronze.read_file_log(spark, store))
    assert sorted(r.DOCUMENT_NUMBER for r in current.collect() if r.source_file_path.endswith("c.parquet")) == [
        "INV3", "INV33"
    ]
    again = bronze.load_bronze(spark, str(landing), store, 2, "2025-02-02 00:00:00")
    assert statuses(again) == loaded
    assert sinks.read_table_or_none(spark, store.table(DETAILED)).count() == 10
    skipped = bronze.load_bronze(spark, str(landing), store, 3, "2025-02-03 00:00:00", path_only=True)
    assert set(statuses(skipped)) == {"broken.parquet"}
    operations = bronze.load_operations(spark, store).filter("feature_name = 'sales'")
    assert {(r.operation_id, r.status, r.files_processed, r.rows_loaded) for r in operations.collect()} == {
        (1, "COMPLETED", 5, 9), (2, "COMPLETED", 3, 4), (3, "COMPLETED", 0, 0)
    }


def test_missing_root_is_empty(spark, tmp_path, store):
    assert files.list_files(spark, str(tmp_path / "nowhere")).count() == 0
    assert files.scan_tree(spark, str(tmp_path / "nowhere")) is None
    log = bronze.load_bronze(spark, str(tmp_path / "nowhere"), store, 1, "2025-02-01 00:00:00")
    assert log.count() == 0


def test_fingerprints_change_with_content(spark, landing):
    import hashlib

    found = {r.file_path: r for r in files.fingerprints(spark, str(landing)).collect()}
    path = next(p for p in found if p.endswith("/a.parquet"))
    with open(path, "rb") as handle:
        assert found[path].file_hash == hashlib.md5(handle.read()).hexdigest()
    by_blocks = {r.file_path: r.file_hash for r in files.fingerprints(spark, str(landing), whole=10).collect()}
    assert by_blocks == {k: r.file_hash for k, r in found.items()}
    listing = files.list_files(spark, str(landing))
    assert files.settled(listing, "2000-01-01 00:00:00").count() == 0
    assert files.settled(listing, "2100-01-01 00:00:00").count() == listing.count()


def test_scan_row_counts(spark, landing):
    scan = files.scan_tree(spark, str(landing / "sales" / "short.parquet"))
    assert [r.rows for r in files.file_row_counts(scan).collect()] == [3]


def test_stream_gives_the_rows_of_the_batch_load(spark, tmp_path):
    root = tmp_path / "landing"
    month = root / "sales" / "cash_invoices" / "detailed" / "2025"
    month.mkdir(parents=True)
    for name, amount in (("a", 1.0), ("b", 2.0), ("c", 3.0)):
        pq.write_table(pa.table({"DOCUMENT_NUMBER": [name], "AMOUNT": [amount]}), month / f"{name}.parquet")
    streamed = BronzeStore(str(tmp_path / "streamed"), str(tmp_path / "stream_logs"))
    schema = spark.read.parquet(str(month / "a.parquet")).schema

    def run():
        stream_bronze(
            spark, str(root), schema, streamed, str(tmp_path / "checkpoint"), "2025-02-01 00:00:00", max_files=2
        ).awaitTermination()

    run()
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["d"], "AMOUNT": [4.0]}), month / "d.parquet")
    run()
    batch = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    bronze.load_bronze(spark, str(root), batch, 1, "2025-02-01 00:00:00")
    columns = ["DOCUMENT_NUMBER", "AMOUNT", "source_file_path"]
    got = spark.read.parquet(streamed.table(DETAILED)).select(*columns).collect()
    want = spark.read.parquet(batch.table(DETAILED)).select(*columns).collect()
    assert sorted(got) == sorted(want) and len(got) == 4
    events = spark.read.parquet(streamed.log("file_watcher_logs"))
    assert sorted(r.file_path.rsplit("/", 1)[-1] for r in events.collect()) == [
        "a.parquet", "b.parquet", "c.parquet", "d.parquet"
    ]


def test_upload_skips_unchanged_and_reloads_changed(spark, tmp_path):
    root = tmp_path / "out" / "Sales.x"
    root.mkdir(parents=True)
    pq.write_table(pa.table({"a": [1, 2]}), root / "One-File.parquet")
    pq.write_table(pa.table({"b": ["x"]}), root / "two.parquet")
    (root / "bad.parquet").write_bytes(b"nope")
    target, log_path = str(tmp_path / "wh"), str(tmp_path / "upload_log")

    def run(stamp, **options):
        log = warehouse.upload(spark, str(root), target, log_path, stamp, "pos", **options)
        return {r.file_path.rsplit("/", 1)[-1]: r for r in log.collect()}

    first = run("2025-01-01 00:00:00")
    assert {k: (v.status, v.records_processed) for k, v in first.items()} == {
        "One-File.parquet": ("SUCCESS", 2), "two.parquet": ("SUCCESS", 1), "bad.parquet": ("FAILED", 0)
    }
    folders = "_".join(part.lower() for part in tmp_path.parts[1:])
    assert first["One-File.parquet"].table_name == f"pos_{folders}_out_sales_one_file"
    pq.write_table(pa.table({"a": [5, 6, 7]}), root / "One-File.parquet")
    second = run("2025-01-02 00:00:00")
    assert str(second["One-File.parquet"].processed_at).startswith("2025-01-02")
    assert str(second["two.parquet"].processed_at).startswith("2025-01-01")
    name = first["One-File.parquet"].table_name
    assert warehouse.read_uploaded(spark, target, name).count() == 5
    run("2025-01-02 00:00:00")
    assert warehouse.read_uploaded(spark, target, name).count() == 5
    run("2025-01-03 00:00:00", incremental=False, disposition=sinks.TRUNCATE)
    assert warehouse.read_uploaded(spark, target, name).count() == 3
    fourth = run("2025-01-04 00:00:00", incremental=False, disposition=sinks.EMPTY)
    assert {r.status for r in fourth.values()} == {"FAILED"}
    with pytest.raises(ValueError):
        run("2025-01-05 00:00:00", disposition="WRITE_SIDEWAYS")


def test_load_table_dispositions(spark, tmp_path):
    df = spark.range(3).toDF("n")
    path = str(tmp_path / "t")
    sinks.load_table(df, path, sinks.EMPTY)
    sinks.load_table(df, path, sinks.APPEND)
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        sinks.load_table(df, path, sinks.EMPTY)
    sinks.load_table(df, path, sinks.TRUNCATE)
    assert spark.read.parquet(path).count() == 3
    sinks.export_csv(df.orderBy("n"), str(tmp_path / "csv"), 2)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    sinks.write_state_json(df, str(tmp_path / "state"))
    assert sinks.read_state_json(spark, str(tmp_path / "state"), "n bigint").count() == 3
    (tmp_path / "bad_state").write_text('{"n": 1}\n{"n": oops\n')
    assert sorted(map(tuple, sinks.read_state_json(spark, str(tmp_path / "bad_state"), "n bigint").collect()), key=str) == [(1, None), (None, '{"n": oops')]
    assert sinks.read_state_json(spark, str(tmp_path / "no_state"), "n bigint").count() == 0


def test_medallion_run(spark, tmp_path):
    root = tmp_path / "landing"
    for grain in ("summarized", "detailed"):
        folder = root / "sales" / "cash_invoices" / grain / "2025" / "january"
        folder.mkdir(parents=True)
        rows = {
            "DOCUMENT_NUMBER": ["INV1 ", "INV1 ", "CN2", None, "INV3"],
            "CUS_CODE": ["C1", "C1", "C2", "C3", ""],
            "TRN_DATE": ["2025-01-31"] * 5,
            "AMOUNT": [10.0, 10.0, -4.0, 5.0, None],
            "BCODE": ["1"] * 5,
        }
        if grain == "detailed":
            rows["ITEM_CODE"] = ["P1"] * 5
            rows["QUANTITY"] = [1.0] * 5
            rows["ITEM_PRICE"] = [10.0] * 5
        pq.write_table(pa.table(rows), folder / "x.parquet")
    bronze_store = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    bronze.load_bronze(spark, str(root), bronze_store, 1, "2025-02-01 00:00:00")
    store = medallion.SilverStore(str(tmp_path / "silver"), str(tmp_path / "silver_logs"))
    done = medallion.run_silver(spark, bronze_store, store, 1, "2025-02-02 00:00:00")
    assert done == {"summarized": True, "detailed": True, "daily_rows": 4}
    lines = spark.read.parquet(store.table("detailed_invoices"))
    assert sorted(r.potential_duplicate_flag for r in lines.collect()) == [0, 1]
    assert "_row_file" not in lines.columns
    log = spark.read.parquet(store.log("process_log")).filter(F.col("status") == "COMPLETED")
    by_target = {r.target_table: r for r in log.collect()}
    detailed = by_target["detailed_invoices"]
    assert (detailed.records_processed, detailed.records_valid, detailed.credit_notes_separated) == (5, 2, 1)
    assert (detailed.records_invalid, detailed.potential_duplicates_detected) == (2, 1)
    assert detailed.whitespace_issues_found == 1
    daily = spark.read.parquet(store.table("daily_sales_summary")).collect()
    assert {(r.data_source, r.invoice_count) for r in daily} == {("SUMMARIZED", 2), ("DETAILED", 1)}
    assert {str(r.net_sales) for r in daily} == {"16.00"}
    deduped = medallion.SilverStore(str(tmp_path / "silver2"), str(tmp_path / "silver2_logs"))
    medallion.run_silver(spark, bronze_store, deduped, 1, "2025-02-02 00:00:00", remove_duplicates=True)
    assert spark.read.parquet(deduped.table("summarized_invoices")).count() == 1


def test_summary_with_a_missing_grain(spark, tmp_path):
    store = medallion.SilverStore(str(tmp_path / "silver"), str(tmp_path / "logs"))
    empty = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "bronze_logs"))
    assert medallion.run_silver(spark, empty, store, 1, "2025-02-02 00:00:00") == {
        "summarized": False, "detailed": False
    }


def test_row_position_is_unique(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    rows = files.read_with_row_id(spark, str(tmp_path / "t"))
    assert rows.select("_row_file", "_row_index").distinct().count() == 100


def test_changed_file_counts_once(spark, tmp_path):
    root = tmp_path / "landing" / "sales" / "cash_invoices" / "summarized" / "2025"
    root.mkdir(parents=True)
    bronze_store = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    for batch, amounts in ((1, [10.0, 20.0]), (2, [10.0, 15.0, 5.0])):
        n = len(amounts)
        pq.write_table(pa.table({"DOCUMENT_NUMBER": [f"INV{i}" for i in range(n)], "CUS_CODE": ["C"] * n, "TRN_DATE": ["2025-01-31"] * n,
                                 "AMOUNT": amounts, "BCODE": ["1"] * n}), root / "x.parquet")
        bronze.load_bronze(spark, str(tmp_path / "landing"), bronze_store, batch, f"2025-02-0{batch} 00:00:00")
    store = medallion.SilverStore(str(tmp_path / "silver"), str(tmp_path / "silver_logs"))
    medallion.run_silver(spark, bronze_store, store, 1, "2025-02-03 00:00:00")
    assert spark.read.parquet(store.table("summarized_invoices")).count() == 3
    assert [str(r.total_sales) for r in spark.read.parquet(store.table("daily_sales_summary")).collect()] == ["30.00"]


def test_new_checkpoint_and_batch_ids_do_not_collide(spark, tmp_path):
    root = tmp_path / "landing" / "sales" / "cash_invoices" / "detailed"
    root.mkdir(parents=True)
    stream_store = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    pq.write_table(pa.table({"DOCUMENT_NUMBER": ["a", "b"], "table_name": ["x", "y"]}), root / "a.parquet")
    schema = spark.read.parquet(str(root / "a.parquet")).schema
    for name in ("one", "two"):
        stream_bronze(spark, str(tmp_path / "landing"), schema, stream_store, str(tmp_path / name), "2025-02-01 00:00:00").awaitTermination()
        if name == "one":
            pq.write_table(pa.table({"DOCUMENT_NUMBER": ["c"], "table_name": ["z"]}), root / "c.parquet")
    with pytest.raises(ValueError):
        bronze.load_bronze(spark, str(root), stream_store, bronze.FIRST_STREAM_BATCH, "2025-02-01 00:00:00")
    rows = spark.read.parquet(stream_store.table("bronze_" + "sales_cash_invoices_detailed"))
    current = bronze.current_rows(rows, bronze.read_file_log(spark, stream_store))
    assert sorted((r.DOCUMENT_NUMBER, r.table_name) for r in current.collect()) == [("a", "x"), ("b", "y"), ("c", "z")]
    assert bronze.load_bronze(spark, str(tmp_path / "landing"), stream_store, 1, "2025-02-02 00:00:00").count() == 0


def test_names_with_special_characters_and_damaged_pages(spark, tmp_path):
    month = tmp_path / "landing" / "sales" / "cash_invoices" / "detailed" / "2025 jan"
    month.mkdir(parents=True)
    for i, name in enumerate(("a b", "c%20d#e", "x{1},[y]+z", "ünï")):
        pq.write_table(pa.table({"DOCUMENT_NUMBER": [f"INV{i}"], "source_file_path": ["theirs"]}), month / f"{name}.parquet")
    good = pa.table({"DOCUMENT_NUMBER": [f"D{i}" for i in range(5000)], "source_file_path": ["theirs"] * 5000})
    pq.write_table(good, month / "damaged.parquet", compression="none", use_dictionary=False)
    raw = bytearray((month / "damaged.parquet").read_bytes())
    raw[4:3000] = b"\xff" * 2996
    (month / "damaged.parquet").write_bytes(bytes(raw))
    store = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    log = statuses(bronze.load_bronze(spark, str(tmp_path / "landing"), store, 1, "2025-02-01 00:00:00"))
    assert log.pop("damaged.parquet")[0] == "FAILED" and set(log.values()) == {("SUCCESS", 1)} and len(log) == 4
    rows = spark.read.parquet(store.table(DETAILED)).collect()
    assert sorted(r.DOCUMENT_NUMBER for r in rows) == ["INV0", "INV1", "INV2", "INV3"]
    assert all(r.source_file_path.endswith(".parquet") for r in rows)
    uploaded = warehouse.upload(spark, str(tmp_path / "landing"), str(tmp_path / "wh"), str(tmp_path / "wl"), "2025-01-01 00:00:00")
    found = {r.file_path.rsplit("/", 1)[-1]: (r.status, r.records_processed) for r in uploaded.collect()}
    assert found.pop("damaged.parquet") == ("FAILED", 0) and set(found.values()) == {("SUCCESS", 1)}


def test_upload_keeps_all_groups_of_a_truncated_table(spark, tmp_path):
    root = tmp_path / "out"
    root.mkdir()
    pq.write_table(pa.table({"a": [1, 2], "table_name": ["p", "q"]}), root / "one-x.parquet")
    pq.write_table(pa.table({"a": ["s"]}), root / "one_x.parquet")
    pq.write_table(pa.table({"a": [1.5]}), root / "two.parquet")
    for stamp in ("2025-01-01 00:00:00", "2025-01-02 00:00:00"):
        log = warehouse.upload(spark, str(root), str(tmp_path / "wh"), str(tmp_path / "wl"), stamp, incremental=False, disposition=sinks.TRUNCATE)
    names = {r.file_path.rsplit("/", 1)[-1]: r.table_name for r in log.collect()}
    assert names["one-x.parquet"] == names["one_x.parquet"]
    folder = tmp_path / "wh" / f"__table={names['one-x.parquet']}"
    assert sum(pq.read_table(f).num_rows for f in folder.rglob("*.parquet")) == 3
    again = warehouse.upload(spark, str(root), str(tmp_path / "wh"), str(tmp_path / "wl"), "2025-01-03 00:00:00", incremental=False, disposition=sinks.EMPTY)
    assert {r.status for r in again.collect()} == {"FAILED"}
    warehouse.upload(spark, str(root), str(tmp_path / "wh2"), str(tmp_path / "wl2"), "2025-01-01 00:00:00")
    warehouse.upload(spark, str(root), str(tmp_path / "wh2"), str(tmp_path / "wl2"), "2025-01-02 00:00:00")
    assert {r.status for r in warehouse.run_events(spark, str(tmp_path / "wl2"), "2025-01-02 00:00:00").collect()} == {"SKIPPED"}
